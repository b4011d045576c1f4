"""The sales pipelines: day and week marts, features, product history."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.scalars import int_or_zero, wall_clock
from shelfline.functions.weeks import week_number
from shelfline.operators import aggregates as agg
from shelfline.operators import features as feat
from shelfline.operators import hierarchy as hier
from shelfline.operators.densify import densify_prices
from shelfline.operators.history import scd2_merge
from shelfline.operators.products import shred_products
from shelfline.operators.reconcile import reconcile_partitions
from shelfline.operators.upsert import KeyedTable, merge_batches
from shelfline.plans.merges import MERGES, merge_columns, merge_table
from shelfline.session import materialize
from shelfline.sources.tables import (
    current_view,
    read_table,
    recover_table,
    replace_partitions,
    replace_range,
    replace_table,
)

# Weeks rebuilt on every run, by generation of the marts, and days reloaded daily.
BASIC_REBUILD_WEEKS = 12
EXTENDED_REBUILD_WEEKS = 7
RELOAD_DAYS = 7

# Weeks the smoothing looks around, and the most a year can hold.
SMOOTHING = 2
YEAR_WEEKS = 53


class LevelMeans(NamedTuple):
    """Scaled weekly means by class, subclass and model."""

    by_class: DataFrame
    by_subclass: DataFrame
    by_model: DataFrame


# ------------------------------------------------------------------ basic marts

def week_first_day(week: Column) -> Column:
    """Monday of a week number."""
    return F.date_from_unix_date((week * 7 - 3).cast("int"))


def rebuild_daily(daily: DataFrame, bounds: DataFrame, first_sale: DataFrame, tasks: int | None = None) -> DataFrame:
    """Dense daily calendar of the weeks to rebuild, prices from the whole history."""
    first = bounds.select(week_first_day(F.col("min_week"))).scalar()
    sunday = F.date_add(week_first_day(F.col("max_week")), 6)
    last = bounds.select(F.least(sunday, F.col("max_date"))).scalar()
    return densify_prices(daily, first, last, first_sale, tasks=tasks)


def basic_weekly(daily: DataFrame) -> DataFrame:
    """Weekly store-item sales with the smoothed quantity."""
    return agg.smooth(agg.agg_week_store_item(daily), ["store", "item"], "item_qty", "smooth_item_qty")


def basic_features(weekly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Store-item features of the week and of the year before."""
    keys = ["store", "item"]
    return (
        feat.offset_features(weekly, keys, feat.BASIC, feat.BASIC_REACH),
        feat.prior_year_features(weekly, feat.week_calendar(weekly), keys, feat.BASIC, feat.BASIC_REACH),
    )


def basic_features_by_item(weekly: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Item features over all stores; ``calendar`` is that of ``weekly``, where it is cheaper to get elsewhere."""
    calendar = feat.week_calendar(weekly) if calendar is None else calendar
    return feat.rollup_over_stores(feat.week_and_year_features(
        weekly, calendar, ["store", "item"], feat.BASIC, feat.BASIC_REACH), feat.BASIC)


# --------------------------------------------------------------- extended marts

def level_means(scaled: DataFrame) -> LevelMeans:
    """The three hierarchy means, each scaled by its best week."""
    return LevelMeans(*[hier.scale_level(hier.avg_by_level(scaled, level), level) for level in hier.LEVELS])


def extended_features(weekly: DataFrame, calendar: DataFrame, exceptions: DataFrame, by_store: bool,
                      places: int | None = None) -> DataFrame:
    """Masked features of the week and the year before, by item or store and item; rounded if ``places`` are given."""
    keys, measures = (["store", "item"], feat.BY_STORE) if by_store else (["item"], feat.BY_ITEM)
    return feat.masked_features(weekly, calendar, exceptions, keys, measures, feat.EXTENDED_REACH, places)


# -------------------------------------------------------------- runs over tables

def refresh_table(spark: SparkSession, name: str, raw_path: str, target_path: str) -> DataFrame:
    """Merge an increment into its table on storage; returns the current view."""
    recover_table(spark, target_path)
    target = read_table(spark, target_path)
    merged, _ = merge_table(name, read_table(spark, raw_path), target)
    replace_table(merged, target_path)
    return current_view(read_table(spark, target_path), target.columns, MERGES[name].is_act)


def refresh_from_batches(spark: SparkSession, name: str, raw_path: str, table: KeyedTable) -> DataFrame:
    """Merge the pending batches into a table stored by key and empty them; returns the current view.

    Only the folders that hold keys of the batches are read and replaced.
    """
    recover_table(spark, table.path)
    merge_batches(spark, raw_path, table, **merge_columns(MERGES[name]))
    return current_view(table.read(spark), table.schema.names, MERGES[name].is_act)


def refresh_tickets(spark: SparkSession, raw_path: str, ods_path: str) -> DataFrame:
    """Reload the ticket days that differ from their raw lines; returns the table."""
    raw, ods = read_table(spark, raw_path), read_table(spark, ods_path)
    changed = reconcile_partitions(raw, ods, "sell_date", agg.aggregate_ticket_lines)
    # Which days differ is read off the table about to change, so settle it first.
    replace_partitions(materialize(changed, "ticket-days"), ods_path, ["sell_date"])
    return read_table(spark, ods_path)


def refresh_product_history(spark: SparkSession, attributes: DataFrame, families: DataFrame,
                            history_path: str, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Shred changed product documents and bring them into the history table."""
    history = read_table(spark, history_path)
    versions = shred_products(attributes, families, as_of, days).withColumn(
        "load_dttm", wall_clock(as_of, history.schema["load_dttm"].dataType))
    stamp = wall_clock(as_of, history.schema["updated_dttm"].dataType)
    replace_table(scd2_merge(history, versions, "item", stamp), history_path)
    return read_table(spark, history_path)


def with_item_numbers(online: DataFrame) -> DataFrame:
    """Online rows with the item as a number, 0 where its text is none."""
    if isinstance(online.schema["item"].dataType, T.StringType):
        return online.withColumn("item", int_or_zero(F.col("item")))
    return online


def build_caps(spark: SparkSession, tickets: DataFrame, online: DataFrame, path: str, stores: list[int]) -> DataFrame:
    """Build the table of quantity caps anew from the lines of the listed stores; returns it."""
    listed = F.col("store").isin(stores)
    replace_table(agg.outlier_caps(tickets.where(listed), with_item_numbers(online.where(listed))), path)
    return read_table(spark, path)


def build_first_sale(spark: SparkSession, tickets: DataFrame, online: DataFrame, earlier: DataFrame, path: str,
                     stores: list[int], sentinel: dt.date | None = dt.date(1970, 1, 1)) -> DataFrame:
    """Build the table of first sale days anew; returns it.

    Shop lines and the earlier system's days count in the listed stores, online sales
    wherever they are booked. ``sentinel`` is the day that stands for "unknown".
    """
    listed = F.col("store").isin(stores)
    sources = [tickets.where(listed), with_item_numbers(online), earlier.where(listed)]
    replace_table(agg.first_sale_date(sources, sentinel), path)
    return read_table(spark, path)


def refresh_days(spark: SparkSession, tickets: DataFrame, first_sale: DataFrame, daily_path: str,
                 calendar_path: str, today: dt.date, days: int = RELOAD_DAYS) -> DataFrame:
    """Reload the newest days of the day sales and of the dense calendar.

    Prices of the calendar come from all days on record, before and after.
    """
    oldest = today - dt.timedelta(days=days)
    first, last = F.lit(oldest), F.lit(today)
    fresh = agg.agg_day_store_item(tickets.where(F.col("sell_date").between(first, last)))
    replace_range(fresh, daily_path, "sell_date", oldest, today)
    dense = densify_prices(read_table(spark, daily_path), first, last, first_sale)
    replace_range(dense, calendar_path, "sell_date", oldest, today)
    return read_table(spark, calendar_path)


def refresh_basic_marts(spark: SparkSession, daily: DataFrame, first_sale: DataFrame, weekly_path: str,
                        features_path: str, back: int = BASIC_REBUILD_WEEKS) -> DataFrame:
    """Rebuild the newest weeks of the weekly mart and the features they reach.

    One job per mart over all weeks and stores; only the partitions of those
    weeks are replaced, and only the weeks they draw on are read.
    """
    kept = read_table(spark, weekly_path)
    bounds = materialize(agg.load_bounds(kept, daily, back), "bounds")
    wider = bounds.withColumns({
        "min_week": F.col("min_week") - SMOOTHING, "max_week": F.col("max_week") + SMOOTHING})
    weekly = basic_weekly(rebuild_daily(daily, wider, first_sale))
    rebuilt = agg.weeks_to_rebuild(weekly, F.col("week_num"), bounds)
    first_week, last_week = bounds.select("min_week", "max_week").first()
    replace_range(rebuilt.select(*kept.columns), weekly_path, "week_num", first_week, last_week)

    reach = feat.BASIC_REACH
    oldest = F.col("min_week") - reach.right
    needed = oldest - 2 * YEAR_WEEKS - reach.year_left
    drawn_on = read_table(spark, weekly_path).where(F.col("week_num") >= bounds.select(needed).scalar())
    features = basic_features_by_item(drawn_on).where(F.col("week_num") >= bounds.select(oldest).scalar())
    replace_range(features, features_path, "week_num", first_week - reach.right)
    return read_table(spark, features_path)


class ExtendedMarts(NamedTuple):
    """Paths of the extended marts below one root."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def refresh_stock_marts(spark: SparkSession, stock: DataFrame, daily: DataFrame, marts: ExtendedMarts,
                        back: int = EXTENDED_REBUILD_WEEKS) -> DataFrame:
    """Rebuild the newest weeks of the stock by store and by item."""
    path = marts.path("stock_by_store")
    bounds = materialize(agg.load_bounds(read_table(spark, path, ["week_num"]), daily, back), "bounds")
    newest = agg.weeks_to_rebuild(stock, week_number(F.to_date("snapshot")), bounds)
    first_week, last_week = bounds.select("min_week", "max_week").first()
    replace_range(agg.agg_stock_by_store(newest), path, "week_num", first_week, last_week)
    by_week = agg.agg_stock_by_week(agg.weeks_to_rebuild(read_table(spark, path), F.col("week_num"), bounds))
    replace_range(by_week, marts.path("stock_by_week"), "week_num", first_week, last_week)
    return read_table(spark, path)


def build_extended_marts(spark: SparkSession, daily: DataFrame, item_dates: DataFrame, attributes: DataFrame,
                         stock_by_store: DataFrame, exceptions: DataFrame, marts: ExtendedMarts) -> None:
    """Build the ticket marts and masked features anew, each written once and read back."""
    def write(df: DataFrame, name: str) -> DataFrame:
        replace_table(df, marts.path(name), ["week_num"])
        return read_table(spark, marts.path(name), df.columns)

    tickets = write(hier.agg_tickets_by_store(daily, item_dates, attributes), "tickets_by_store")
    scaled = write(hier.avg_scaled_with_stock(tickets, stock_by_store), "avg_tickets_by_week")
    means = LevelMeans(*[
        hier.scale_level(write(hier.avg_by_level(scaled, level), f"avg_tickets_by_{level}"), level)
        for level in hier.LEVELS])
    sums = write(agg.sum_tickets_by_week(tickets), "sum_tickets_by_week")
    by_week = write(hier.attr_by_week(sums, *means), "tickets_attr_by_week")
    by_store = write(hier.attr_by_store(tickets, *means), "tickets_attr_by_store")
    calendar = write(feat.week_calendar(tickets), "calendar")
    write(extended_features(by_week, calendar, exceptions, by_store=False), "features_by_item")
    write(extended_features(by_store, calendar, exceptions, by_store=True), "features_by_store")
