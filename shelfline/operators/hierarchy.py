"""Item attributes and weekly means along the product hierarchy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.exact import exact_mean, exact_sum
from shelfline.functions.scalars import key_prefix, mean_of, natural_key
from shelfline.functions.weeks import WEEK_KEYS, week_columns
from shelfline.operators import keyed
from shelfline.operators.aggregates import scale_by_max
from shelfline.operators.keyed import DEAL, heavy_join

# Attribute number under which an item's stop date is kept.
STOP_DATE_UDA = 6

# An item drops out of the weekly marts this many days before its stop date.
STOP_MARGIN_DAYS = 14

# Weeks that the lines of a level may have in all to be broadcast, eight bytes each.
MOST_LINE_WEEKS = 4_000_000


def item_attr(master: DataFrame, products: DataFrame) -> DataFrame:
    """Hierarchy key and model of every current product, model -1 if unknown."""
    current = products.where(F.col("is_actual") == "1").select("item", "model")
    return master.join(current, "item").select(
        "item",
        natural_key(F.col("dept"), F.col("class"), F.col("subclass")).alias("dept_class_subclass"),
        F.coalesce(F.col("model").cast("string"), F.lit("-1")).alias("model"),
    )


def agg_tickets_by_store(daily: DataFrame, item_dates: DataFrame, attributes: DataFrame,
                         counted: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Weekly sales per store and item with attributes, without items being stopped.

    ``counted`` tells which items are frequent, where it is cheaper to read than ``daily``.
    Days laid out by item in advance stay where they are: by ``keyed.dealt_by``, or by the item
    alone, of which there is a row per day and store at most, over so many ``tasks``.
    """
    def looked_up(rows: DataFrame, lookup: DataFrame) -> DataFrame:
        if tasks is None:
            return heavy_join(rows, lookup, ["item"], counted=counted)
        # Laid out like the rows, or Spark would lay out anew the side of fewer tasks.
        return rows.join(lookup if keyed.within_broadcast(lookup) else lookup.repartition(tasks, "item"), "item", "left")

    stops = item_dates.where(F.col("uda_id") == STOP_DATE_UDA).select("item", "uda_date")
    still_sold = F.col("uda_date").isNull() | (F.col("uda_date") > F.date_add("sell_date", STOP_MARGIN_DAYS))
    weekly = (
        looked_up(daily, stops).where(still_sold)
        .groupBy(*week_columns(F.col("sell_date")), "store", "item", *([DEAL] if DEAL in daily.columns else [])).agg(
            exact_sum(F.col("item_qty")).alias("week_item_qty"),
            exact_sum(F.col("purchase_price")).alias("sum_purchase_price"),
            F.count("item_qty").alias("count_tickets"),
        )
    )
    return looked_up(weekly, attributes).select(
        *WEEK_KEYS, "store", "item", "dept_class_subclass", "model",
        "week_item_qty", "sum_purchase_price", "count_tickets",
    )


def avg_scaled_with_stock(tickets: DataFrame, stock: DataFrame, tasks: int | None = None) -> DataFrame:
    """Weekly mean over stores of the quantity scaled by the store's best week.

    Store weeks without a stock record do not count. Sales and stock are laid out
    once, by item, over ``tasks``, if given; all steps then stay where the rows are.
    """
    keys = ["item", "store", "week_num"]
    records = stock.select(*[F.col(key).cast(tickets.schema[key].dataType).alias(key) for key in keys], F.lit(1).alias("_stock"))
    both = tickets.withColumn("_stock", F.lit(0)).unionByName(records, allowMissingColumns=True)
    both = both.repartition("item") if tasks is None else both.repartition(tasks, "item")
    counted = both.withColumn("_records", F.sum("_stock").over(Window.partitionBy(*keys)))
    scaled = scale_by_max(counted, ["item", "store"], "week_item_qty", "scaled").where(F.col("_stock") == 0)
    # A missing key is equal to none; a stock record that comes twice counts twice.
    stocked = (F.col("_records") > 0) & reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])
    return (
        scaled.groupBy(*WEEK_KEYS, "item", "dept_class_subclass", "model")
        .agg(exact_mean(F.when(stocked, F.col("scaled")), F.col("_records")).alias("avg_item_qty_scaled_with_stock"))
    )


def class_key(key: Column | None = None) -> Column:
    """'dept|class' out of 'dept|class|subclass'."""
    return key_prefix(F.col("dept_class_subclass") if key is None else key, 2)


LEVELS = {
    "class": ("dept_class", class_key),
    "subclass": ("dept_class_subclass", lambda: F.col("dept_class_subclass")),
    "model": ("model", lambda: F.col("model")),
}


def avg_by_level(weekly: DataFrame, level: str) -> DataFrame:
    """Weekly mean of the scaled quantity over the items of a class, subclass or model."""
    name, key = LEVELS[level]
    return weekly.groupBy(*WEEK_KEYS, key().alias(name)).agg(
        exact_mean(F.col("avg_item_qty_scaled_with_stock")).alias(f"avg_item_qty_by_{level}"))


def scale_level(averages: DataFrame, level: str) -> DataFrame:
    """Level means over the largest mean of the same class, subclass or model."""
    name, _ = LEVELS[level]
    out = f"avg_item_qty_by_{level}_scaled"
    return scale_by_max(averages, [name], f"avg_item_qty_by_{level}", out).select("week_num", name, out)


def level_lines(averages: DataFrame, level: str) -> DataFrame:
    """Scaled means as one row per class, subclass or model: its first week, and a list of its means week by week.

    Such a list takes eight bytes a week, a row per week many times that, so that
    the lines of far more means can be broadcast. Means that Spark broadcasts by their
    size anyway, that would make lines of over ``MOST_LINE_WEEKS`` or have two rows in
    a week are returned as they are. ``averages`` is read once to tell, and should be written.
    """
    if keyed.within_broadcast(averages):
        return averages
    name, _ = LEVELS[level]
    known = averages.where(F.col(name).isNotNull() & F.col("week_num").isNotNull())
    span = (F.max("week_num") - F.min("week_num") + 1).cast("bigint")
    weeks, repeated = known.groupBy(name).agg(
        span.alias("weeks"), (F.count("week_num") - F.count_distinct("week_num")).alias("repeated"),
    ).agg(F.sum("weeks"), F.max("repeated")).first()
    if (weeks or 0) > MOST_LINE_WEEKS or repeated:
        return averages
    value = f"avg_item_qty_by_{level}_scaled"
    gap = "array_repeat(CAST(NULL AS DOUBLE), coalesce(get(_weeks, i + 1).week_num - e.week_num - 1, 0))"
    return known.groupBy(name).agg(
        F.sort_array(F.collect_list(F.struct("week_num", value))).alias("_weeks"),
    ).selectExpr(name, "_weeks[0].week_num AS _first",
                 f"flatten(transform(_weeks, (e, i) -> concat(array(CAST(e.{value} AS DOUBLE)), {gap}))) AS _line")


def joined_in_place(averages: DataFrame) -> bool:
    """Whether level means, or the lines made of them, are broadcast and leave the rows where they are."""
    return "_line" in averages.columns or keyed.within_broadcast(averages)


def attach_level_averages(rows: DataFrame, by_class: DataFrame, by_subclass: DataFrame,
                          by_model: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Add the three scaled level means, or ``level_lines`` of them, to weekly item or store-item rows.

    Rows without attributes get a key of their own that matches nothing, so
    that they spread over the join's tasks instead of meeting in one. A level that
    holds very many items, like model -1, is joined by broadcast. ``counted`` tells
    which levels do, where it is cheaper to read than ``rows``.
    """
    counted = rows if counted is None else counted
    alone = F.concat(F.lit("no attributes of "), F.col("item").cast("string"))
    joined = rows
    for level, averages in (("class", by_class), ("subclass", by_subclass), ("model", by_model)):
        name, key = LEVELS[level]
        side = averages.where(F.col(name).isNotNull()).withColumnRenamed(name, "_level")
        level_key = F.coalesce(key(), alone)
        if "_line" in averages.columns:
            mean = F.get("_line", (F.col("week_num") - F.col("_first")).cast("int"))
            joined = joined.withColumn("_level", level_key).join(F.broadcast(side), "_level", "left").withColumn(
                f"avg_item_qty_by_{level}_scaled", mean).drop("_level", "_first", "_line")
            continue
        joined = heavy_join(joined.withColumn("_level", level_key), side, ["week_num", "_level"],
                            counted=counted.select("week_num", level_key.alias("_level")))
    out = [f"avg_item_qty_by_{level}_scaled" for level in LEVELS]
    return joined.select(*rows.columns, *out)


def attr_by_week(weekly: DataFrame, by_class: DataFrame, by_subclass: DataFrame,
                 by_model: DataFrame, counted: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Weekly item rows with level means, quantity scaled by the item's best week.

    With the means the rows are laid out by key over ``tasks``, if given.
    """
    rows = attach_level_averages(weekly, by_class, by_subclass, by_model, counted)
    if tasks is not None:
        rows = rows.repartition(tasks, "item")
    return scale_by_max(rows, ["item"], "sum_item_qty", "sum_item_qty_scaled")


def attr_by_store(by_store: DataFrame, by_class: DataFrame, by_subclass: DataFrame,
                  by_model: DataFrame, counted: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Weekly store-item rows with level means, quantity scaled by the pair's best week.

    With the means the rows are laid out by key over ``tasks``, if given.
    """
    rows = by_store.select(
        *WEEK_KEYS, "store", "item", "dept_class_subclass", "model", "week_item_qty",
        mean_of(F.col("sum_purchase_price"), F.col("count_tickets")).alias("avg_purchase_price"),
    )
    joined = attach_level_averages(rows, by_class, by_subclass, by_model, counted)
    if tasks is not None:
        joined = joined.repartition(tasks, "store", "item")
    return scale_by_max(joined, ["item", "store"], "week_item_qty", "week_item_qty_scaled")
