"""Domain inputs (tickets, stock, attributes, documents) out of the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.scalars import natural_key, wall_clock
from shelfline.functions.weeks import week_number
from shelfline.operators.aggregates import agg_day_store_item
from shelfline.operators.keyed import dealt_by
from shelfline.sources.tables import read_table

# Orders from this day on form the increment, earlier ones the table merged into.
CUT = dt.date(2000, 1, 1)
OPEN_END = dt.datetime(2999, 12, 31)
EXCEPTION_WEEKS = (10, 19, 45)

# Ticket lines that one task is dealt.
LINES_PER_TASK = 100_000


def moment(value: dt.datetime) -> Column:
    """A wall-clock literal, as the driver tables hold them."""
    return wall_clock(value, T.TimestampNTZType())


class Inputs:
    """The driver's tables of one folder, seen as sales data."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._tasks: int | None = None

    def table(self, name: str, *columns: str) -> DataFrame:
        """A driver table; its schema is read once however often it is used."""
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, f"{self.folder}/{name}.parquet")
        return self._tables[name].select(*columns) if columns else self._tables[name]

    def tasks(self) -> int:
        """Tasks for as many rows as there are ticket lines, by a count that reads no column.

        Tasks of a counted number hold as much whatever the table's size. Left to
        itself Spark fills a task up to a compressed size, which says little about
        the rows and features it will hold.
        """
        if self._tasks is None:
            self._tasks = self.table("lineitem").count() // LINES_PER_TASK + 1
        return self._tasks

    def dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        """Rows laid out by key over counted tasks; groupings and windows by these keys then stay in place."""
        return df.repartition(self.tasks(), *keys)

    def tickets(self) -> DataFrame:
        """Ticket lines; returned goods stand for online sales."""
        return self.table(
            "lineitem", "l_suppkey", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag",
        ).select(
            (F.col("l_suppkey") % 10).cast("int").alias("store"),
            F.col("l_partkey").alias("item"),
            F.to_date("l_shipdate").alias("sell_date"),
            F.col("l_quantity").alias("item_qty"),
            F.col("l_extendedprice").alias("total_cost"),
            (F.col("l_returnflag") == "R").alias("online"),
        )

    def daily(self) -> DataFrame:
        """Day, store and item sales without outlier capping."""
        return self._uncapped(self.dealt(self.tickets(), "store", "item"))

    def daily_by_item(self) -> DataFrame:
        """The same laid out by item, frequent items also by store, for lookups by item."""
        tickets = self.tickets()
        return self._uncapped(dealt_by(tickets, ["item"], ["store"], self.tasks(), tickets.select("item")))

    def _uncapped(self, tickets: DataFrame) -> DataFrame:
        return agg_day_store_item(tickets.withColumns({
            "item_qty_raw": F.col("item_qty"), "item_qty_processed": F.col("item_qty")}))

    def ordered(self) -> DataFrame:
        """Items with the day they were ordered."""
        orders = self.table("orders", "o_orderkey", "o_orderdate")
        return (
            self.table("lineitem", "l_orderkey", "l_partkey")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_partkey").alias("item"), F.to_date("o_orderdate").alias("sell_date"))
        )

    def sale_sources(self) -> list[DataFrame]:
        tickets = self.tickets()
        return [
            tickets.where(~F.col("online")).select("item", "sell_date"),
            tickets.where("online").select("item", "sell_date"),
            self.ordered(),
        ]

    def ticket_lines(self) -> DataFrame:
        """Raw ticket lines with all the columns of a receipt."""
        line = self.table("lineitem")
        stamp = F.col("l_shipdate").cast("timestamp_ntz")
        return line.select(
            (F.col("l_suppkey") % 10).cast("int").alias("store"),
            (F.col("l_suppkey") % 4).cast("int").alias("checkout_number"),
            F.col("l_orderkey").alias("ticket_number"),
            F.to_date("l_shipdate").alias("sell_date"),
            F.lit("12:00").alias("ticket_time"),
            F.col("l_returnflag").alias("transaction_type"),
            F.col("l_partkey").alias("item"),
            F.bround(F.col("l_extendedprice") / F.col("l_quantity")).alias("purchase_price"),
            F.col("l_extendedprice").alias("total_cost"),
            (F.col("l_extendedprice") * (1 - F.col("l_tax"))).alias("total_cost_wo_tax"),
            F.col("l_quantity").alias("item_qty"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("total_margin"),
            F.lit("0").alias("num_acp"),
            F.col("l_linestatus").alias("num_cde"),
            stamp.alias("created_dttm"),
            (stamp + F.expr("interval 1 second") * F.col("l_linenumber")).alias("load_dttm"),
        )

    def stock(self) -> DataFrame:
        """Stock snapshots, some of them empty or negative."""
        return self.tickets().select(
            "store", "item", F.col("sell_date").alias("snapshot"),
            (F.col("item_qty") - 25).alias("current_qty"))

    def item_master(self) -> DataFrame:
        return self.table("part", "p_partkey", "p_brand", "p_size", "p_type").select(
            F.col("p_partkey").alias("item"),
            F.substring_index("p_brand", "#", -1).cast("int").alias("dept"),
            F.col("p_size").alias("class"),
            F.col("p_type").alias("subclass"))

    def products(self) -> DataFrame:
        """Models; size 1 has none, and promoted articles are no longer current."""
        return self.table("part", "p_partkey", "p_size", "p_type").select(
            F.col("p_partkey").alias("item"),
            F.nullif("p_size", F.lit(1)).alias("model"),
            F.when(F.col("p_type") == "PROMO", "0").otherwise("1").alias("is_actual"))

    def item_dates(self) -> DataFrame:
        """Stop dates of large articles, and another date of all."""
        part = self.table("part", "p_partkey", "p_size").select(F.col("p_partkey").alias("item"), "p_size")
        stops = part.where(F.col("p_size") > 45).select(
            "item", F.lit(6).alias("uda_id"), F.lit(dt.date(1999, 1, 1)).alias("uda_date"))
        return stops.unionByName(part.select(
            "item", F.lit(7).alias("uda_id"), F.lit(dt.date(1996, 1, 1)).alias("uda_date")))

    def exceptions(self, calendar: DataFrame) -> DataFrame:
        """Exception weeks of every year on record."""
        return calendar.where(F.col("week").isin(*EXCEPTION_WEEKS)).select(
            "year", "week_num", (F.col("week_num") + 52).alias("next_week_num"))

    def orders(self) -> DataFrame:
        return self.table("orders").withColumn("o_orderdate", F.to_date("o_orderdate"))

    def order_increment(self) -> DataFrame:
        return self.orders().where(F.col("o_orderdate") >= F.lit(CUT))

    def order_target(self) -> DataFrame:
        return self.orders().where(F.col("o_orderdate") < F.lit(CUT))

    def order_versions(self, orders: DataFrame) -> DataFrame:
        """A customer's orders as versions, each valid until the next one.

        Orders of a customer on the same day count as one, so a customer has at
        most one version per calendar day.
        """
        started = orders.groupBy("o_custkey", "o_orderdate").agg(
            F.max("o_orderkey").alias("o_orderkey"),
            F.max("o_totalprice").alias("o_totalprice"))
        by_customer = Window.partitionBy("o_custkey").orderBy("o_orderdate")
        following = F.lead("o_orderdate").over(by_customer)
        start = F.col("o_orderdate").cast("timestamp_ntz")
        return started.withColumn("following", following).select(
            "o_custkey", "o_orderkey", "o_totalprice",
            start.alias("created_dttm"), start.alias("valid_from_dttm"),
            F.coalesce(F.col("following").cast("timestamp_ntz") - F.expr("interval 1 second"),
                       moment(OPEN_END)).alias("valid_to_dttm"),
            start.alias("updated_dttm"),
            F.when(F.col("following").isNull(), "1").otherwise("0").alias("is_actual"),
            start.alias("load_dttm"))

    def attribute_documents(self) -> DataFrame:
        """Product documents as JSON text, written from the part table."""
        part = self.table("part")
        def entry(key: str, value: Column) -> Column:
            return F.concat(F.lit(f'"{key}": ["'), value.cast("string"), F.lit('"]'))

        text = F.concat(F.lit("{"), F.concat_ws(
            ", ",
            entry("12963", F.col("p_name")),
            entry("model_modelID", F.col("p_partkey") * 7),
            entry("01181", F.col("p_type")),
            entry("letterRange", F.substring("p_type", 1, 1)),
            entry("mgtNomencProduct_mgtNomenc_departmentID", F.col("p_size") * 8),
            entry("mgtNomencProduct_mgtNomenc_subDepartmentID", F.substring_index("p_brand", "#", -1)),
            entry("mgtNomencProduct_mgtNomenc_categoryID", F.col("p_brand")),
        ), F.lit("}"))
        stamp = moment(dt.datetime(2024, 1, 1)) + F.expr("interval 1 day") * F.col("p_size")
        return part.select(
            F.col("p_partkey").cast("string").alias("product_id"), text.alias("attributes"),
            stamp.alias("stamp"), stamp.alias("valid_from_dttm"),
            moment(OPEN_END).alias("valid_to_dttm"), stamp.alias("updated_dttm"))

    def family_documents(self) -> DataFrame:
        """Family lists as JSON text; the smallest articles have an empty list."""
        part = self.table("part")
        def family(name: str, kind: str) -> Column:
            return F.concat(F.lit('{"id": "'), F.col(name), F.lit(f'", "type": "{kind}"}}'))

        filled = F.concat(F.lit("["), F.concat_ws(
            ", ", family("p_brand", "STANDARD"), family("p_type", "OTHER"), family("p_name", "STANDARD"),
        ), F.lit("]"))
        stamp = moment(dt.datetime(2024, 1, 21)) + F.expr("interval 12 hour") * F.col("p_size")
        return part.where(F.col("p_type") != "SMALL").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.when(F.col("p_size") < 5, "[]").otherwise(filled).alias("families"),
            stamp.alias("stamp"), stamp.alias("valid_from_dttm"),
            moment(OPEN_END).alias("valid_to_dttm"), stamp.alias("updated_dttm"))

    def user_weeks(self) -> DataFrame:
        """Event values as weekly item values for clustering."""
        return self.table("events", "user_id", "ts", "value").groupBy(
            F.col("user_id").alias("item"), week_number(F.to_date("ts")).alias("week_num"),
        ).agg(F.sum("value").alias("value"))

    def text_keys(self) -> DataFrame:
        return self.table("part").select(
            "p_partkey", natural_key(F.col("p_brand"), F.col("p_size"), F.col("p_type")).alias("key"))
