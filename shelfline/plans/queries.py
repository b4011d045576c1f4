"""Registered queries: each operator over the driver's whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import jsondocs, scalars, weeks
from shelfline.operators import aggregates as agg
from shelfline.operators import asof, clustering, history, keyed, products, reconcile, upsert
from shelfline.operators import densify as dense
from shelfline.operators import features as feat
from shelfline.operators import hierarchy as hier
from shelfline.plans import sales
from shelfline.plans.inputs import CUT, Inputs, moment
from shelfline.session import materialize, scratch_path
from shelfline.sources import tables

STORES = [1, 2, 3, 5, 8]
AS_OF = dt.datetime(2024, 2, 20)
MERGE_TIME = dt.datetime(2002, 1, 1)
LOADED_UNTIL = dt.date(2001, 1, 1)
RECENT_DAYS = 30
CALENDAR_DAYS = 7

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Add a query; sums of floating values are rounded so that they can be compared."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(build(Inputs(spark, folder)))

    _QUERIES[build.__name__] = run
    return build


def register_as_is(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Add a query whose values are moved only, or added up in whatever order with the same bits."""
    _QUERIES[build.__name__] = lambda spark, folder: build(Inputs(spark, folder))
    return build


# Places that sums of floating values are rounded to.
PLACES = 6


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    return df.selectExpr(*[
        f"round({f.name}, {places}) AS {f.name}" if isinstance(f.dataType, T.DoubleType) else f.name
        for f in df.schema])


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ------------------------------------------------------------ sources and sinks

@register
def full_replace_roundtrip(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "orders")
    tables.append_table(i.order_target(), path)
    stored = tables.read_table(i.spark, path)
    merged, _ = keyed.merge_increment(i.order_increment(), stored, ["o_custkey"], "o_orderdate")
    tables.replace_table(merged, path)
    return tables.read_table(i.spark, path)


@register
def partition_replace_roundtrip(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "sales-by-year")
    def by_month(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.year("sell_date").alias("year"), F.month("sell_date").alias("month"), "store").agg(
            F.count(F.lit(1)).alias("tickets"), F.sum("item_qty").alias("item_qty"))

    tables.replace_partitions(by_month(i.tickets().where("online")), path, ["year"])
    late = i.tickets().where(F.year("sell_date") >= 1999)
    tables.replace_partitions(by_month(late), path, ["year"])
    return tables.read_table(i.spark, path, ["year", "month", "store", "tickets", "item_qty"])


@register
def range_replace_roundtrip(i: Inputs) -> DataFrame:
    """A rebuilt range of years whose middle year lost all its rows."""
    path = scratch_path(i.spark, "sales-by-year")
    years = i.tickets().groupBy(F.year("sell_date").alias("year"), "store", "online").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("item_qty").alias("item_qty"))
    tables.replace_table(years, path, ["year"])
    rebuilt = years.where("online AND year BETWEEN 1997 AND 1999 AND year <> 1998")
    tables.replace_range(rebuilt, path, "year", 1997, 1999)
    return tables.read_table(i.spark, path, ["year", "store", "online", "tickets", "item_qty"])


# Folders of the tables that the queries lay out by key.
BUCKETS = 64


def _keyed_orders(i: Inputs, order_by: str | None) -> upsert.KeyedTable:
    """The target's orders, one per customer, stored by key."""
    target = i.order_target()
    table = upsert.KeyedTable(scratch_path(i.spark, "orders-by-key"), target.schema, ("o_custkey",), order_by, BUCKETS)
    upsert.create_table(target, table)
    return table


@register
def upsert_batches(i: Inputs) -> DataFrame:
    """Batches by order status, merged by the order field and consumed."""
    table, raw = _keyed_orders(i, "o_orderdate"), scratch_path(i.spark, "order-batches")
    for status in ("P", "O", "F"):
        upsert.add_batch(i.order_increment().where(F.col("o_orderstatus") == status), raw, status)
        if status == "O":
            upsert.merge_batches(i.spark, raw, table)
    upsert.merge_batches(i.spark, raw, table)
    return table.read(i.spark)


@register
def upsert_newest_batch(i: Inputs) -> DataFrame:
    """Batches by year without an order field: the newest batch that has a key wins, in whatever order they are merged."""
    table, raw = _keyed_orders(i, None), scratch_path(i.spark, "order-batches")
    last = i.order_increment().agg(F.max(F.year("o_orderdate"))).first()[0]
    for year in [*range(CUT.year + 1, last + 1), CUT.year]:
        upsert.add_batch(i.order_increment().where(F.year("o_orderdate") == year), raw, str(year))
        upsert.merge_batches(i.spark, raw, table)
    return table.read(i.spark)


@register
def upsert_untouched(i: Inputs) -> DataFrame:
    """The last day merged into all earlier ones; whether files changed only in folders of that day's customers."""
    orders = i.orders()
    last = orders.agg(F.max("o_orderdate")).first()[0]
    earlier, day = orders.where(F.col("o_orderdate") < last), orders.where(F.col("o_orderdate") == last)
    table = upsert.KeyedTable(
        scratch_path(i.spark, "orders-by-key"), orders.schema, ("o_custkey",), "o_orderdate", BUCKETS)
    upsert.create_table(earlier, table)
    before = tables.files_below(i.spark, table.path)
    upsert.upsert(day, table)
    after = tables.files_below(i.spark, table.path)
    stored = table.stored(i.spark)
    hit = {row[0] for row in stored.where(F.col("o_orderdate") == last).select(table.bucket).distinct().collect()}
    changed = {int(name.partition("=")[2]) for name in after if before.get(name) != after[name]}
    return table.read(i.spark).withColumn("only_touched", F.lit(changed == hit and set(before) <= set(after)))


@register
def dump_resumed(i: Inputs) -> DataFrame:
    """Two dumps, the second from where the first ended: every row once."""
    path = scratch_path(i.spark, "orders-dumps")
    written = [tables.resume_dump(df, path, "o_orderdate") for df in (i.order_target(), i.orders())]
    return tables.read_table(i.spark, path).select(
        "o_orderkey", "o_custkey", "o_orderdate", "dump",
        F.get(F.array(*[F.lit(n).cast("bigint") for n in written]), F.col("dump")).alias("rows_written"))


@register
def current_view(i: Inputs) -> DataFrame:
    versions = i.orders().withColumn(
        "is_actual", F.when(F.col("o_orderstatus") == "F", "0").otherwise("1"))
    return tables.current_view(versions, ["o_orderkey", "o_custkey", "o_orderdate"], "is_actual")


@register
def incremental_dump_slice(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "orders-dump")
    written = tables.incremental_dump(
        i.orders(), path, "o_orderdate", dt.date(1998, 1, 1), dt.date(1999, 6, 30), codec="gzip")
    return tables.read_table(i.spark, path).select(
        "o_orderkey", "o_custkey", "o_orderdate", F.lit(written).cast("bigint").alias("rows_written"))


@register
def export_projection(i: Inputs) -> DataFrame:
    return tables.export_projection(i.table("events"))


@register
def export_schema_cast(i: Inputs) -> DataFrame:
    part = i.table("part", "p_partkey", "p_name", "p_size").select(
        "p_partkey", F.col("p_name").alias("p$name"), F.col("p_size").cast("short").alias("p$size"))
    return tables.export_schema(part)


# ------------------------------------------------- projections, filters, scalars

@register
def filter_stores(i: Inputs) -> DataFrame:
    return i.tickets().where(F.col("store").isin(STORES)).select("store", "item", "sell_date", "item_qty")


@register
def filter_not_like(i: Inputs) -> DataFrame:
    goods = i.tickets().where(~F.col("item").cast("string").like("49%"))
    return goods.groupBy("item").agg(F.count(F.lit(1)).alias("tickets"), F.sum("item_qty").alias("item_qty"))


@register
def filter_between(i: Inputs) -> DataFrame:
    return (
        i.tickets().where(F.col("sell_date").between(dt.date(1997, 3, 1), dt.date(1998, 8, 31)))
        .groupBy("sell_date").agg(F.count(F.lit(1)).alias("tickets"))
    )


@register
def filter_recent(i: Inputs) -> DataFrame:
    recent = tables.recent_rows(i.orders(), "o_orderdate", dt.datetime(2001, 8, 1), RECENT_DAYS)
    return recent.select("o_orderkey", "o_orderdate", "o_totalprice")


@register
def case_flags(i: Inputs) -> DataFrame:
    return i.table("part", "p_partkey", "p_type", "p_size", "p_brand").select(
        "p_partkey",
        scalars.true_flag(F.when(F.col("p_type") == "SMALL", "t").otherwise("f")).alias("same_type"),
        scalars.true_flag(F.when(F.col("p_size") > 25, F.when(F.col("p_size") > 40, "t"))).alias("same_model_id"),
        F.when(F.col("p_size") < 10, "low").when(F.col("p_size") < 30, "mid").otherwise("high").alias("band"))


@register
def distinct_store_item(i: Inputs) -> DataFrame:
    return i.tickets().select("store", "item").distinct()


@register
def distinct_store_sorted(i: Inputs) -> DataFrame:
    offline = i.tickets().where(~F.col("online")).select("store")
    return offline.unionByName(i.tickets().where("online").select("store")).distinct().orderBy("store")


@register
def scalar_weeks(i: Inputs) -> DataFrame:
    day = F.col("o_orderdate")
    return i.orders().select("o_orderdate").distinct().select(
        "o_orderdate", *weeks.week_columns(day), F.trunc(day, "week").alias("monday"))


@register
def scalar_casts(i: Inputs) -> DataFrame:
    number = F.substring_index("p_brand", "#", -1)
    return i.table("part", "p_partkey", "p_brand", "p_size", "p_type").select(
        "p_partkey",
        scalars.unsigned_or_null((F.col("p_size") * 8).cast("string"), 8).cast("int").alias("as_u8"),
        scalars.unsigned_or_null((F.col("p_partkey") * 97).cast("string"), 16).alias("as_u16"),
        scalars.unsigned_or_null(F.concat(F.lit("42949672"), number.cast("string")), 32).alias("as_u32"),
        scalars.unsigned_or_null(F.col("p_brand"), 32).alias("not_a_number"),
        scalars.int_or_zero(number).alias("int_or_zero"),
        scalars.int_or_zero(F.col("p_type")).alias("zero"),
        scalars.int_or_zero(F.lpad(F.col("p_partkey").cast("string"), 14, "0")).alias("padded"),
        scalars.unsigned_or_null(F.lpad(F.col("p_partkey").cast("string"), 14, "0"), 32).alias("padded_u32"))


@register
def scalar_dates(i: Inputs) -> DataFrame:
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "dd.MM.yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "yyyyMMdd"))
        .when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority"))
        .when(F.col("o_orderkey") % 3 == 0, F.unix_seconds(day.cast("timestamp")).cast("string"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "yyyy-MM-dd'T'03:04:05.123'Z'"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    stamp = day.cast("timestamp_ntz")
    return i.orders().select(
        "o_orderkey",
        F.to_date(scalars.parse_timestamp(text)).alias("parsed"),
        F.date_add(day, 14).alias("in_two_weeks"),
        F.date_format(stamp - F.expr("interval 1 second"), "yyyy-MM-dd HH:mm:ss").alias("second_before"),
        F.date_format(stamp + F.expr("interval 1 second"), "yyyy-MM-dd HH:mm:ss").alias("second_after"))


@register
def scalar_split_key(i: Inputs) -> DataFrame:
    return i.text_keys().select(
        "p_partkey", "key", scalars.key_prefix(F.col("key"), 2).alias("two"), scalars.key_prefix(F.col("key"), 1).alias("one"))


@register
def natural_key(i: Inputs) -> DataFrame:
    return i.products().select(
        "item", scalars.natural_key(F.col("item"), F.col("model"), F.col("is_actual")).alias("nk"))


@register
def scalar_null_rules(i: Inputs) -> DataFrame:
    rows = i.stock().select(
        "store", F.when(F.col("current_qty") > 20, F.lit(float("nan")))
        .when(F.col("current_qty") < -20, None).otherwise(F.col("current_qty")).alias("qty"))
    return rows.groupBy("store").agg(
        F.sum(scalars.no_value(F.col("qty")).cast("int")).alias("nothing"),
        F.sum(scalars.valid_price(F.col("qty"))).alias("positive"),
        F.min(F.least(scalars.valid_price(F.col("qty")), F.lit(3.0))).alias("least"))


@register
def json_props(i: Inputs) -> DataFrame:
    fields = [products.NAME, products.MODEL, products.SUBCLASS]
    documents = i.attribute_documents().withColumn("doc", jsondocs.first_of_each(F.col("attributes"), fields))
    return documents.select(
        "product_id",
        F.col("doc")[products.NAME].alias("name"),
        F.col("doc")[products.MODEL].alias("model"),
        F.col("doc")[products.SUBCLASS].alias("missing"),
        jsondocs.first_of(F.col("attributes"), products.GAMMA).alias("gamma"))


@register
def json_array_filter(i: Inputs) -> DataFrame:
    text = F.col("families")
    return i.family_documents().select(
        "product_id", jsondocs.list_length(text).alias("entries"),
        F.array_join(jsondocs.ids_of_type(text, "STANDARD"), ",").alias("standard"))


# ------------------------------------------------------------------------ joins

@register
def join_inner_attr(i: Inputs) -> DataFrame:
    attributes = hier.item_attr(i.item_master(), i.products())
    per_item = i.tickets().groupBy("item").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("item_qty").alias("item_qty"))
    return per_item.join(attributes, "item").groupBy("dept_class_subclass", "model").agg(
        F.sum("tickets").alias("tickets"), F.sum("item_qty").alias("item_qty"))


def _tickets_by_store(i: Inputs, daily: DataFrame, tasks: int | None = None) -> DataFrame:
    return hier.agg_tickets_by_store(
        daily, i.item_dates(), hier.item_attr(i.item_master(), i.products()), i.tickets().select("item"), tasks)


def _store_weeks(i: Inputs) -> DataFrame:
    return _tickets_by_store(i, i.daily_by_item())


def _stock_weeks(i: Inputs) -> DataFrame:
    """Weekly stock per store and item."""
    # Cast first: the grouping stays where its rows are only if it is by the very same column.
    stock = i.stock().withColumn("store", F.col("store").cast("short"))
    return agg.agg_stock_by_store(i.dealt(stock, "store", "item"))


@register
def join_inner_multi(i: Inputs) -> DataFrame:
    stock = _stock_weeks(i).withColumn("store", F.col("store").cast("int"))
    return _store_weeks(i).join(stock, ["week_num", "store", "item"]).select(
        "week_num", "store", "item", "week_item_qty", "sum_week_qty", "is_zero_qty_week")


@register
def join_left_attrs(i: Inputs) -> DataFrame:
    attributes = hier.item_attr(i.item_master(), i.products())
    weekly = i.daily().groupBy(weeks.week_number(F.col("sell_date")).alias("week_num"), "item").agg(
        F.sum("item_qty").alias("item_qty"))
    return weekly.join(attributes, "item", "left").select(
        "week_num", "item", "item_qty", "dept_class_subclass", "model")


@register
def anti_no_increment(i: Inputs) -> DataFrame:
    fresh = i.order_increment().select("o_custkey")
    return i.order_target().join(fresh, "o_custkey", "left_anti").select("o_orderkey", "o_custkey", "o_orderdate")


def _sales_days(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """All sales days, and those with a price."""
    days = materialize(i.daily().select(
        "sell_date", "store", "item", F.unix_date("sell_date").alias("day"), "purchase_price"), "sales-days")
    return days.select("sell_date", "store", "item", "day"), days.where(F.col("purchase_price") > 0)


@register
def asof_past(i: Inputs) -> DataFrame:
    days, priced = _sales_days(i)
    return asof.asof_join(
        days, priced, ["store", "item"], "day",
        {"purchase_price": "price_past"}, strict=True).drop("day")


@register
def asof_future(i: Inputs) -> DataFrame:
    days, priced = _sales_days(i)
    return asof.asof_join(
        days, priced, ["item"], "day",
        {"purchase_price": "price_future", "day": "day_future"}, "forward", strict=True).drop("day")


def _item_weeks(i: Inputs) -> DataFrame:
    return i.daily().groupBy(*weeks.week_columns(F.col("sell_date")), "item").agg(F.sum("item_qty").alias("item_qty"))


def _calendar(i: Inputs) -> DataFrame:
    """Week calendar of the sales days, which are few next to the sales."""
    days = i.tickets().select("sell_date").distinct()
    return feat.week_calendar(days.select(*weeks.week_columns(F.col("sell_date"))))


@register
def asof_inclusive(i: Inputs) -> DataFrame:
    return asof.asof_dictionary(
        _item_weeks(i), i.exceptions(_calendar(i)), "year", "week_num",
        {"exception_before": ("backward", 0), "exception_after": ("forward", 0)})


@register
def asof_offset(i: Inputs) -> DataFrame:
    return asof.asof_dictionary(
        _item_weeks(i), i.exceptions(_calendar(i)), "year", "week_num",
        {"first_in_reach": ("forward", 8), "last_in_reach": ("backward", -10)})


# ------------------------------------------------------------------- aggregates

@register
def agg_ticket_lines(i: Inputs) -> DataFrame:
    return agg.aggregate_ticket_lines(i.ticket_lines())


@register
def outlier_caps(i: Inputs) -> DataFrame:
    return agg.outlier_caps(i.tickets().where(~F.col("online")), i.tickets().where("online"), tasks=i.tasks())


@register
def caps_of_stores(i: Inputs) -> DataFrame:
    tickets, path = i.tickets(), scratch_path(i.spark, "caps")
    return sales.build_caps(i.spark, tickets.where(~F.col("online")), tickets.where("online"), path, STORES)


@register
def first_sale_of_stores(i: Inputs) -> DataFrame:
    tickets = i.tickets()
    ordered = (
        i.table("lineitem", "l_orderkey", "l_partkey", "l_suppkey")
        .join(i.table("orders", "o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select((F.col("l_suppkey") % 10).cast("int").alias("store"), F.col("l_partkey").alias("item"),
                F.to_date("o_orderdate").alias("sell_date"))
    )
    return sales.build_first_sale(
        i.spark, tickets.where(~F.col("online")), tickets.where("online"), ordered,
        scratch_path(i.spark, "first-sale"), STORES)


def _capped_days(i: Inputs, split_by_raw_qty: bool = False) -> DataFrame:
    """Sales of a day, store and item with capped quantities; the lines meet their caps where they are added up."""
    tickets, items = i.tickets(), i.tickets().select("item")
    caps = agg.outlier_caps(tickets.where(~F.col("online")), tickets.where("online"), tasks=i.tasks())
    capped = agg.cap_quantities(keyed.dealt_by(tickets, ["item"], ["store"], i.tasks(), items), caps, counted=items)
    return agg.agg_day_store_item(capped, split_by_raw_qty=split_by_raw_qty).drop(keyed.DEAL)


@register
def capped_quantities(i: Inputs) -> DataFrame:
    return _capped_days(i)


@register
def agg_day_store_item(i: Inputs) -> DataFrame:
    return i.daily()


@register
def agg_day_store_item_split(i: Inputs) -> DataFrame:
    return _capped_days(i, split_by_raw_qty=True)


@register
def first_sale_date(i: Inputs) -> DataFrame:
    return agg.first_sale_date(i.sale_sources())


@register
def agg_week_store_item(i: Inputs) -> DataFrame:
    return agg.agg_week_store_item(i.daily())


@register
def smooth_week_qty(i: Inputs) -> DataFrame:
    return sales.basic_weekly(i.daily()).select("week_num", "store", "item", "item_qty", "smooth_item_qty")


@register
def agg_stock_by_store(i: Inputs) -> DataFrame:
    return _stock_weeks(i).withColumn("store", F.col("store").cast("int"))


@register
def agg_stock_by_week(i: Inputs) -> DataFrame:
    return agg.agg_stock_by_week(i.dealt(_stock_weeks(i), "week_num", "item"))


@register
def agg_tickets_by_store(i: Inputs) -> DataFrame:
    return _store_weeks(i)


def _scaled(i: Inputs) -> DataFrame:
    return hier.avg_scaled_with_stock(_store_weeks(i), _stock_weeks(i), i.tasks())


@register
def avg_scaled_with_stock(i: Inputs) -> DataFrame:
    return _scaled(i)


@register
def sum_tickets_by_week(i: Inputs) -> DataFrame:
    return agg.sum_tickets_by_week(_store_weeks(i))


@register
def avg_by_class(i: Inputs) -> DataFrame:
    return hier.avg_by_level(_scaled(i), "class")


@register
def avg_by_subclass(i: Inputs) -> DataFrame:
    return hier.avg_by_level(_scaled(i), "subclass")


@register
def avg_by_model(i: Inputs) -> DataFrame:
    return hier.avg_by_level(_scaled(i), "model")


def _means(i: Inputs, tickets: DataFrame) -> sales.LevelMeans:
    scaled = materialize(hier.avg_scaled_with_stock(tickets, _stock_weeks(i), i.tasks()), "scaled-weeks")
    # Written, because they are looked up more than once and their size decides how they are joined.
    return sales.LevelMeans(*[
        hier.level_lines(materialize(means, "level-means"), level)
        for level, means in zip(hier.LEVELS, sales.level_means(scaled), strict=True)])


def _attr_of(i: Inputs, tickets: DataFrame, by_store: bool) -> DataFrame:
    """Store weeks, or item weeks, with level means; laid out by key for the features that follow.

    Small means, and lines of larger ones, are broadcast and leave the layout as it is;
    still larger ones are joined by level, and the rows are laid out after that.
    """
    means = _means(i, tickets)
    stays = all(hier.joined_in_place(side) for side in means)
    tasks = None if stays else i.tasks()
    if by_store:
        rows = i.dealt(tickets, "store", "item") if stays else tickets
        return hier.attr_by_store(rows, *means, counted=tickets, tasks=tasks)
    return hier.attr_by_week(agg.sum_tickets_by_week(i.dealt(tickets, "item")), *means, counted=tickets, tasks=tasks)


def _attr_weeks(i: Inputs) -> DataFrame:
    return _attr_of(i, materialize(_store_weeks(i), "store-weeks"), by_store=False)


def _attr_store_weeks(i: Inputs) -> DataFrame:
    return _attr_of(i, materialize(_store_weeks(i), "store-weeks"), by_store=True)


@register_as_is
def attr_by_week(i: Inputs) -> DataFrame:
    return _attr_weeks(i)


@register_as_is
def attr_by_store(i: Inputs) -> DataFrame:
    return _attr_store_weeks(i)


@register
def max_val_by_key(i: Inputs) -> DataFrame:
    return agg.max_by_key(_store_weeks(i), ["item", "store"], "week_item_qty", "max_week_item_qty")


@register
def load_bounds(i: Inputs) -> DataFrame:
    loaded = i.orders().select(weeks.week_number(F.col("o_orderdate")).alias("week_num"))
    return agg.load_bounds(loaded, i.tickets(), sales.BASIC_REBUILD_WEEKS)


@register
def load_bounds_empty(i: Inputs) -> DataFrame:
    nothing = i.orders().where(F.col("o_orderdate").isNull()).select(
        weeks.week_number(F.col("o_orderdate")).alias("week_num"))
    return agg.load_bounds(nothing, i.tickets(), sales.BASIC_REBUILD_WEEKS)


@register
def partition_counts(i: Inputs) -> DataFrame:
    return tables.partition_counts(i.tickets(), "sell_date")


# --------------------------------------------------------------------- per key

@register
def latest_by_key(i: Inputs) -> DataFrame:
    return keyed.latest_by(i.orders(), ["o_custkey"], ["o_orderdate"])


@register
def top_n_by_key(i: Inputs) -> DataFrame:
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return keyed.top_n_by(i.orders().select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], order, 3)


@register
def merge_increment(i: Inputs) -> DataFrame:
    merged, _ = keyed.merge_increment(i.order_increment(), i.order_target(), ["o_custkey"], "o_orderdate")
    return merged


@register
def merge_current_view(i: Inputs) -> DataFrame:
    """Latest order per customer by natural key, only where it is still open."""
    def states(orders: DataFrame) -> DataFrame:
        return orders.select(
            F.concat_ws("|", "o_custkey", "o_orderpriority").alias("nk"), "o_custkey", "o_orderpriority",
            "o_orderkey", F.col("o_orderdate").alias("created_dttm"),
            F.when(F.col("o_orderstatus") == "F", "f").otherwise("t").alias("is_actual"))

    old = states(i.order_target()).withColumn("is_actual", scalars.true_flag(F.col("is_actual")))
    _, current = keyed.merge_increment(
        states(i.order_increment()).drop("nk"), old, ["nk"], "created_dttm",
        nk=scalars.natural_key(F.col("o_custkey"), F.col("o_orderpriority")),
        mapping={"is_actual": scalars.true_flag(F.col("is_actual"))}, is_act="is_actual")
    return current


def _text_stamps(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)) else F.col(f.name) for f in df.schema])


@register
def key_bounds(i: Inputs) -> DataFrame:
    return _text_stamps(history.key_bounds(i.order_versions(i.order_increment()), "o_custkey"))


@register
def scd2_merge(i: Inputs) -> DataFrame:
    stored = materialize(i.order_versions(i.order_target()), "versions")
    fresh = materialize(i.order_versions(i.order_increment()), "new-versions")
    return _text_stamps(history.scd2_merge(stored, fresh, "o_custkey", moment(MERGE_TIME)))


def _loaded_lines(i: Inputs) -> DataFrame:
    """Tickets loaded so far: nothing of the last year, no late returns of a December."""
    late = (F.month("sell_date") == 12) & (F.col("transaction_type") == "R")
    return agg.aggregate_ticket_lines(i.ticket_lines().where((F.col("sell_date") < F.lit(LOADED_UNTIL)) & ~late))


@register
def reconcile_partitions(i: Inputs) -> DataFrame:
    reloaded = reconcile.reconcile_partitions(
        i.ticket_lines(), _loaded_lines(i), "sell_date", agg.aggregate_ticket_lines)
    return _text_stamps(reloaded)


@register
def partitions_to_reload(i: Inputs) -> DataFrame:
    return reconcile.partitions_to_reload(
        i.ticket_lines(), _loaded_lines(i), "sell_date", agg.TICKET_LINE_KEYS)


# --------------------------------------------------------- calendar and features

def _last_days(i: Inputs) -> tuple:
    """First and last day of the daily reload: a week back from the newest sale."""
    newest = i.tickets().agg(F.max("sell_date").alias("newest"))
    return (
        newest.select(F.date_sub("newest", CALENDAR_DAYS)).scalar(),
        newest.select("newest").scalar(),
    )


@register
def densify_calendar(i: Inputs) -> DataFrame:
    return dense.densify_calendar(i.daily(), *_last_days(i))


@register
def densify_prices(i: Inputs) -> DataFrame:
    return dense.densify_prices(i.daily(), *_last_days(i), agg.first_sale_date(i.sale_sources()))


@register
def weekly_rebuild(i: Inputs) -> DataFrame:
    """Weekly mart of the newest full weeks over the dense calendar."""
    loaded = i.tickets().select(weeks.week_number(F.col("sell_date")).alias("week_num"))
    bounds = agg.load_bounds(loaded, i.tickets(), sales.EXTENDED_REBUILD_WEEKS)
    daily = sales.rebuild_daily(i.daily(), bounds, agg.first_sale_date(i.sale_sources()), i.tasks())
    return agg.agg_week_store_item(daily)


def _capped_dense_days(i: Inputs) -> DataFrame:
    """Caps, capped days and the dense calendar of the newest weeks, from ticket lines."""
    capped = materialize(_capped_days(i), "capped-days")
    loaded = i.tickets().select(weeks.week_number(F.col("sell_date")).alias("week_num"))
    bounds = agg.load_bounds(loaded, i.tickets(), sales.EXTENDED_REBUILD_WEEKS)
    return sales.rebuild_daily(capped, bounds, agg.first_sale_date(i.sale_sources()), i.tasks())


@register_as_is
def chain_basic(i: Inputs) -> DataFrame:
    """The basic run from ticket lines to features: caps, capped days, dense newest weeks, weekly sales, offsets."""
    return feat.offset_features(
        rounded(sales.basic_weekly(_capped_dense_days(i))), ["store", "item"], feat.BASIC, feat.BASIC_REACH)


def _extended_chain(i: Inputs, by_store: bool) -> DataFrame:
    """The extended run over the dense newest weeks: weekly tickets, stock, hierarchy means, masked features."""
    # The dense days are laid out by item.
    tickets = materialize(_tickets_by_store(i, _capped_dense_days(i), i.tasks()), "store-weeks")
    calendar = _calendar(i)
    return sales.extended_features(_attr_of(i, tickets, by_store), calendar, i.exceptions(calendar), by_store, PLACES)


@register_as_is
def chain_extended(i: Inputs) -> DataFrame:
    return _extended_chain(i, by_store=False)


@register_as_is
def chain_extended_store(i: Inputs) -> DataFrame:
    return _extended_chain(i, by_store=True)


@register
def week_calendar(i: Inputs) -> DataFrame:
    return _calendar(i)


def _basic_weeks(i: Inputs) -> DataFrame:
    return materialize(rounded(sales.basic_weekly(i.daily())), "basic-weeks")


@register_as_is
def features_by_week(i: Inputs) -> DataFrame:
    return feat.offset_features(
        rounded(sales.basic_weekly(i.daily())), ["store", "item"], feat.BASIC, feat.BASIC_REACH)


@register_as_is
def features_by_year(i: Inputs) -> DataFrame:
    return sales.basic_features(_basic_weeks(i))[1]


@register
def features_v1(i: Inputs) -> DataFrame:
    weekly = _basic_weeks(i)
    # The calendar is read off the weeks as written: drawn from the dealt ones, it would deal them twice more.
    return sales.basic_features_by_item(i.dealt(weekly, "item"), feat.week_calendar(weekly))


@register_as_is
def features_v2_week(i: Inputs) -> DataFrame:
    return feat.offset_features(_attr_weeks(i), ["item"], feat.BY_ITEM, feat.EXTENDED_REACH)


@register_as_is
def features_v2_store_week(i: Inputs) -> DataFrame:
    return feat.offset_features(_attr_store_weeks(i), ["store", "item"], feat.BY_STORE, feat.EXTENDED_REACH)


@register_as_is
def features_v2_year(i: Inputs) -> DataFrame:
    return feat.prior_year_features(_attr_weeks(i), _calendar(i), ["item"], feat.BY_ITEM, feat.EXTENDED_REACH)


@register_as_is
def features_v2_store_year(i: Inputs) -> DataFrame:
    return feat.prior_year_features(
        _attr_store_weeks(i), _calendar(i), ["store", "item"], feat.BY_STORE, feat.EXTENDED_REACH)


@register_as_is
def features_combined(i: Inputs) -> DataFrame:
    # Not written: both sides take the item weeks from the one shuffle that lays them out, and meet where they lie.
    weekly = _attr_weeks(i)
    return feat.combine_features(
        feat.offset_features(weekly, ["item"], feat.BY_ITEM, feat.EXTENDED_REACH, spread=False),
        feat.prior_year_features(weekly, _calendar(i), ["item"], feat.BY_ITEM, feat.EXTENDED_REACH, spread=False),
        ["item"], feat.BY_ITEM, feat.EXTENDED_REACH)


@register_as_is
def features_v2_masked(i: Inputs) -> DataFrame:
    calendar = _calendar(i)
    return sales.extended_features(_attr_weeks(i), calendar, i.exceptions(calendar), by_store=False)


@register_as_is
def features_v2_store_masked(i: Inputs) -> DataFrame:
    calendar = _calendar(i)
    return sales.extended_features(_attr_store_weeks(i), calendar, i.exceptions(calendar), by_store=True)


# ----------------------------------------------------------- products, clusters

@register
def shred_products(i: Inputs) -> DataFrame:
    shredded = products.shred_products(
        i.attribute_documents(), i.family_documents(), AS_OF, RECENT_DAYS)
    return _text_stamps(shredded.withColumns({
        "dep": F.col("dep").cast("int"), "families": F.array_join("families", ",")}))


@register
def item_attr(i: Inputs) -> DataFrame:
    return hier.item_attr(i.item_master(), i.products())


@register
def pivot_week_item(i: Inputs) -> DataFrame:
    return clustering.pivot_weeks(i.user_weeks(), "value")


@register
def cluster_items(i: Inputs) -> DataFrame:
    """K-means labels differ from run to run of any engine; that each item has the nearest centre does not."""
    return clustering.cluster_check(i.user_weeks(), "value")


@register
def cluster_certificate(i: Inputs) -> DataFrame:
    """With fewer clusters than items: each label is nearest, each centre the mean of its members."""
    return clustering.cluster_certificate(i.user_weeks(), "value", k=8, starts=3)
