"""Ticket, day and week aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.exact import exact_mean, exact_sum
from shelfline.functions.quantile import exact_quantile
from shelfline.functions.scalars import mean_of, no_value
from shelfline.functions.weeks import WEEK_KEYS, week_columns, week_number
from shelfline.operators.keyed import DEAL, heavy_join

# The columns that tell ticket lines apart.
TICKET_LINE_KEYS = [
    "store", "checkout_number", "ticket_number", "sell_date", "ticket_time",
    "transaction_type", "item", "purchase_price", "num_acp", "num_cde",
]

# An item never sold before the forecast horizon counts as first sold here.
NEVER_SOLD = dt.date(2040, 1, 1)

# First week loaded into an empty mart.
HISTORY_START = dt.date(2018, 1, 1)


def aggregate_ticket_lines(lines: DataFrame) -> DataFrame:
    """Sum repeated lines of a ticket, keeping the earliest load stamps."""
    sums = ["total_cost", "total_cost_wo_tax", "item_qty", "total_margin"]
    stamps = ["created_dttm", "load_dttm"]
    return lines.groupBy(*TICKET_LINE_KEYS).agg(
        *[F.sum(name).alias(name) for name in sums],
        *[F.min(name).alias(name) for name in stamps],
    )


def outlier_caps(offline: DataFrame, online: DataFrame, min_n: int = 10, q: float = 0.95,
                 k: float = 1.5, tasks: int | None = None) -> DataFrame:
    """Quantity caps per item for shop and online sales.

    A channel caps at its ``q`` quantile (shops: times ``k``) once it has more than
    ``min_n`` tickets, before that at its maximum. Shops follow the channel with
    more tickets; online keeps its own cap if it has enough tickets or leads.
    Inputs: item, item_qty; lines without a quantity do not count. Equal lines are
    counted in ``tasks``, if given, else in the tasks that read them and once more.
    """
    lines = (
        offline.select(F.lit("off").alias("channel"), "item", "item_qty")
        .unionByName(online.select(F.lit("on").alias("channel"), "item", "item_qty"))
    )
    keys = ["channel", "item"]
    if tasks is not None:
        lines = lines.repartition(tasks, *keys, "item_qty")
    counted = lines.groupBy(*keys, "item_qty").agg(F.count(F.lit(1)).alias("n"))
    sizes = exact_quantile(counted, keys, "item_qty", "n", q, "high")

    def of(channel: str, column: str, zero: object = 0.0) -> Column:
        picked = F.max(F.when(F.col("channel") == channel, F.col(column)))
        return F.coalesce(picked, F.lit(zero))

    wide = sizes.groupBy("item").agg(
        of("off", "rows", 0).alias("n_off"), of("off", "top").alias("top_off"),
        (of("off", "high") * k).alias("high_off"),
        of("on", "rows", 0).alias("n_on"), of("on", "top").alias("top_on"),
        of("on", "high").alias("high_on"),
    )
    cap_off = F.when(F.col("n_off") > min_n, F.col("high_off")).otherwise(F.col("top_off"))
    cap_on = F.when(F.col("n_on") > min_n, F.col("high_on")).otherwise(F.col("top_on"))
    keeps_own = (F.col("n_on") > min_n) | (F.col("n_on") >= F.col("n_off"))
    return wide.select(
        "item",
        F.when(F.col("n_off") >= F.col("n_on"), cap_off).otherwise(cap_on).alias("item_qty_max_offline"),
        F.when(keeps_own, cap_on).otherwise(cap_off).alias("item_qty_max_online"),
    )


def cap_quantities(tickets: DataFrame, caps: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Add raw and capped quantity; items without a cap keep theirs. ``counted`` is as for ``heavy_join``."""
    joined = heavy_join(tickets, caps.select("item", "item_qty_max_offline"), ["item"], counted=counted)
    return joined.select(
        *tickets.columns,
        F.col("item_qty").alias("item_qty_raw"),
        F.least("item_qty", "item_qty_max_offline").alias("item_qty_processed"),
    )


def agg_day_store_item(tickets: DataFrame, stores: list[int] | None = None,
                       split_by_raw_qty: bool = False) -> DataFrame:
    """Sales of a day, store and item with the price paid per piece, halves rounded to even.

    Items whose number starts with 49 are deliveries and left out. With
    ``split_by_raw_qty`` lines of different raw quantity stay separate rows. The ``DEAL``
    of lines laid out by ``dealt_by`` is kept.
    """
    lines = tickets.where(~F.col("item").cast("string").like("49%"))
    if stores is not None:
        lines = lines.where(F.col("store").isin(stores))
    keys = ["sell_date", "store", "item", *([DEAL] if DEAL in lines.columns else [])]
    per_day = lines.groupBy(*keys, *(["item_qty_raw"] if split_by_raw_qty else [])).agg(
        F.count(F.lit(1)).alias("tickets_qty"),
        exact_sum(F.col("total_cost")).alias("total_cost"),
        exact_sum(F.col("item_qty_processed")).alias("item_qty"),
        exact_sum(F.col("item_qty_raw")).alias("raw_qty"),
    )
    price = F.bround(mean_of(F.col("total_cost"), F.col("raw_qty")))
    return per_day.select(*keys, "tickets_qty", "total_cost", "item_qty", price.alias("purchase_price"))


def first_sale_date(sources: list[DataFrame], sentinel: dt.date | None = None,
                    missing: dt.date = NEVER_SOLD) -> DataFrame:
    """Earliest sale per item over all sources (item, sell_date).

    ``sentinel`` is a date that stands for "unknown" in the sources.
    """
    sales = sources[0].select("item", "sell_date")
    for source in sources[1:]:
        sales = sales.unionByName(source.select("item", "sell_date"))
    day = F.to_date("sell_date")
    known = F.when(day != F.lit(sentinel), day) if sentinel else day
    return (
        sales.where(F.col("item") > 0).groupBy("item")
        .agg(F.coalesce(F.min(known), F.lit(missing)).alias("item_first_sale_date"))
    )


def agg_week_store_item(daily: DataFrame) -> DataFrame:
    """Weekly quantity, mean daily quantity and mean price per store and item."""
    return daily.groupBy(*week_columns(F.col("sell_date")), "store", "item").agg(
        exact_sum(F.col("item_qty")).alias("item_qty"),
        exact_mean(F.col("item_qty")).alias("avg_item_qty"),
        exact_mean(F.col("purchase_price")).alias("avg_purchase_price"),
    )


def smooth(weekly: DataFrame, keys: list[str], value: str, out: str, half: int = 2) -> DataFrame:
    """Mean of the weekly value over the weeks within ``half`` of each week."""
    around = Window.partitionBy(*keys).orderBy("week_num").rangeBetween(-half, half)
    return weekly.withColumn(out, F.avg(value).over(around))


def agg_stock_by_store(stock: DataFrame, stores: list[int] | None = None) -> DataFrame:
    """Weekly stock of a store and item; negative stock counts as none."""
    rows = stock if stores is None else stock.where(F.col("store").isin(stores))
    qty = F.greatest(F.col("current_qty"), F.lit(0.0))
    qty = F.when(F.col("current_qty").isNotNull(), qty)
    days = rows.select(
        week_number(F.to_date("snapshot")).alias("week_num"),
        F.col("store").cast("short").alias("store"), "item",
        qty.alias("qty"), F.when(qty == 0, 1).otherwise(0).alias("empty"),
    )
    return days.groupBy("week_num", "store", "item").agg(
        exact_mean(F.col("qty")).alias("avg_week_qty_by_store"),
        F.max("qty").alias("max_week_qty_by_store"),
        exact_sum(F.col("qty")).alias("sum_week_qty"),
        F.count("qty").alias("cnt_days_in_week"),
        F.sum("empty").alias("zero_qty_cnt_by_store"),
        F.when(F.count("qty") == F.sum("empty"), 1).otherwise(0).alias("is_zero_qty_week"),
        F.when(F.sum("empty") != 0, 1).otherwise(0).alias("is_zero_qty_week_part"),
    )


def agg_stock_by_week(by_store: DataFrame) -> DataFrame:
    """Weekly stock of an item over its stores, mean weighted by days."""
    return by_store.groupBy("week_num", "item").agg(
        mean_of(exact_sum(F.col("sum_week_qty")), F.sum("cnt_days_in_week")).alias("avg_qty_by_week"),
        exact_sum(F.col("avg_week_qty_by_store")).alias("sum_avg_week_qty_by_store"),
        exact_sum(F.col("max_week_qty_by_store")).alias("sum_max_week_qty_by_store"),
        F.sum("is_zero_qty_week_part").alias("num_zero_stock_week_part"),
        F.sum("is_zero_qty_week").alias("num_zero_stock_week_all"),
    )


def sum_tickets_by_week(by_store: DataFrame) -> DataFrame:
    """Weekly quantity and mean price of an item over its stores."""
    return by_store.groupBy(*WEEK_KEYS, "item", "dept_class_subclass", "model").agg(
        exact_sum(F.col("week_item_qty")).alias("sum_item_qty"),
        mean_of(exact_sum(F.col("sum_purchase_price")), F.sum("count_tickets")).alias("avg_purchase_price"),
    )


def max_by_key(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Largest value per key."""
    return df.groupBy(*keys).agg(F.max(value).alias(out))


def scale_by_max(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Value over the largest value of its key; 0 where that is 0 or unknown.

    For weekly rows: a key has one row per calendar week.
    """
    top = F.max(value).over(Window.partitionBy(*keys))
    scaled = F.when(no_value(F.col("_top")), F.lit(0.0)).otherwise(mean_of(F.col(value), F.col("_top")))
    return df.withColumn("_top", top).withColumn(out, scaled).drop("_top")


def load_bounds(target: DataFrame, source: DataFrame, back: int,
                start: dt.date = HISTORY_START) -> DataFrame:
    """One row: first and last week to rebuild, and the source's date range.

    Starts ``back`` weeks before the newest loaded week, or at ``start`` if the
    target is empty; ends with the last full week of the source.
    """
    first = target.agg(
        F.coalesce(F.max("week_num") - back, week_number(F.lit(start))).alias("min_week")
    ).scalar()
    return source.agg(
        F.min(F.to_date("sell_date")).alias("min_date"),
        F.max(F.to_date("sell_date")).alias("max_date"),
    ).select(
        "min_date", "max_date",
        first.alias("min_week"),
        (week_number(F.col("max_date")) - 1).alias("max_week"),
    )


def weeks_to_rebuild(df: DataFrame, week: Column, bounds: DataFrame) -> DataFrame:
    """Rows whose week lies inside the one-row bounds."""
    return df.where(week.between(
        bounds.select("min_week").scalar(), bounds.select("max_week").scalar()))
