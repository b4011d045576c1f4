from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline.operators import aggregates as agg
from shelfline.operators import features as feat
from shelfline.operators import hierarchy as hier
from shelfline.operators.clustering import certify, cluster_items, pivot_weeks
from shelfline.operators.densify import densify_prices
from shelfline.operators.products import shred_products
from shelfline.plans import sales
from shelfline.plans.inputs import Inputs
from shelfline.sources.tables import append_table, read_table, replace_partitions

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, FOLDER)


def test_shredding_takes_the_later_stamps(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    doc = '{"12963": ["N"], "model_modelID": ["5"], "mgtNomencProduct_mgtNomenc_departmentID": ["300"]}'
    attributes = spark.createDataFrame(
        [(p, doc, day(d), day(d), day(30), day(d)) for p, d in [("1", 10), ("2", 20), ("3", 10), ("x", 20), ("4", 2)]],
        "product_id string, attributes string, stamp timestamp, valid_from_dttm timestamp, valid_to_dttm timestamp, updated_dttm timestamp")
    families = spark.createDataFrame(
        [("1", '[{"id": "f", "type": "STANDARD"}, {"id": "g", "type": "OTHER"}]', day(15), day(15), day(29), day(15)),
         ("2", '[{"id": "f", "type": "OTHER"}]', day(15), day(15), day(15), day(15)), ("3", "[]", day(28), day(28), day(28), day(28))],
        "product_id string, families string, stamp timestamp, valid_from_dttm timestamp, valid_to_dttm timestamp, updated_dttm timestamp")
    got = {r.item: r for r in shred_products(attributes, families, day(17), 7).collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1].families, got[1].created_dttm, got[1].valid_to_dttm) == (["f"], day(15), day(30))
    assert (got[2].families, got[2].valid_from_dttm) == ([], day(20))
    assert (got[3].families, got[3].created_dttm) == (None, day(10))
    assert (got[1].name, got[1].model, got[1].dep, got[1].is_actual) == ("N", 5, None, "1")


def test_item_attributes_of_current_products(spark):
    master = spark.createDataFrame([(1, 2, 3, 4), (2, 2, 3, 5), (3, 2, 3, 6)], "item int, dept int, class int, subclass int")
    products = spark.createDataFrame([(1, 9, "1"), (2, None, "1"), (3, 9, "0")], "item int, model int, is_actual string")
    assert rows(hier.item_attr(master, products)) == [(1, "2|3|4", "9"), (2, "2|3|5", "-1")]


def test_scaled_mean_counts_stocked_stores_only(spark):
    tickets = spark.createDataFrame(
        [(1, 1, w, s, 7, "1|2|3", "m", q) for w, s, q in [(1, 1, 5.0), (2, 1, 10.0), (1, 2, 4.0), (2, 2, 2.0)]],
        "year int, week int, week_num int, store int, item int, dept_class_subclass string, model string, week_item_qty double")
    stock = spark.createDataFrame([(1, 1, 7), (1, 2, 7)], "week_num int, store short, item int")
    got = {r.week_num: r.avg_item_qty_scaled_with_stock for r in hier.avg_scaled_with_stock(tickets, stock).collect()}
    assert got == {1: (0.5 + 1.0) / 2, 2: None}


def test_level_means_reach_rows_and_rows_without_attributes_stay(spark):
    week = "year int, week int, week_num int, item int, dept_class_subclass string, model string, sum_item_qty double"
    weekly = spark.createDataFrame([(1, 1, 1, 7, "1|2|3", "m", 2.0), (1, 1, 1, 8, None, None, 4.0), (1, 2, 2, 7, "1|2|3", "m", 8.0)], week)
    c = spark.createDataFrame([(1, "1|2", 0.5), (1, None, 0.9)], "week_num int, dept_class string, avg_item_qty_by_class_scaled double")
    s = spark.createDataFrame([(1, "1|2|3", 0.6)], "week_num int, dept_class_subclass string, avg_item_qty_by_subclass_scaled double")
    m = spark.createDataFrame([(2, "m", 0.7)], "week_num int, model string, avg_item_qty_by_model_scaled double")
    got = rows(hier.attr_by_week(weekly, c, s, m).drop("year", "week", "dept_class_subclass", "model"))
    assert got == [(1, 7, 2.0, 0.5, 0.6, None, 0.25), (1, 8, 4.0, None, None, None, 1.0), (2, 7, 8.0, None, None, 0.7, 1.0)]


def test_pivot_and_clusters(spark):
    weekly = spark.createDataFrame([(1, 5, 1.0), (1, 6, 1.1), (2, 5, 1.0), (3, 6, 50.0), (4, 6, 51.0)],
                                   "item int, week_num int, value double")
    assert rows(pivot_weeks(weekly, "value")) == [(1, 1.0, 1.1), (2, 1.0, 0.0), (3, 0.0, 50.0), (4, 0.0, 51.0)]
    labels = dict(rows(cluster_items(weekly, "value", k=2, starts=3)))
    assert labels[1] == labels[2] != labels[3] == labels[4]


def test_the_certificate_fails_for_shuffled_labels_and_moved_centres(spark):
    labelled = spark.createDataFrame(
        [(1, 0, [0.0, 1.0]), (2, 0, [0.0, 3.0]), (3, 1, [9.0, 9.0]), (4, 1, [11.0, 9.0])], "item int, label int, place array<double>")
    centres = spark.createDataFrame([(0, [0.0, 2.0]), (1, [10.0, 9.0]), (2, [50.0, 50.0])], "label int, centre array<double>")
    assert rows(certify(labelled, centres)) == [(n, True, True) for n in (1, 2, 3, 4)]
    shuffled = labelled.withColumn("label", (F.col("item") % 2).cast("int"))
    assert rows(certify(shuffled, centres)) == [(1, False, False), (2, True, False), (3, True, False), (4, False, False)]
    moved = centres.withColumn("centre", F.when(F.col("label") == 1, F.array(F.lit(10.5), F.lit(9.0))).otherwise(F.col("centre")))
    assert rows(certify(labelled, moved), "item", "centre_is_mean") == [(1, True), (2, True), (3, False), (4, False)]


def test_caps_and_first_sales_of_listed_stores(spark, tmp_path):
    schema = "store int, item {}, item_qty double, sell_date date"
    day = lambda n: dt.date(2024, 1, n)
    shops = spark.createDataFrame([(1, 7, 3.0, day(9)), (1, 7, 2.0, day(8)), (9, 7, 50.0, day(1)), (9, 8, 1.0, day(2))], schema.format("int"))
    online = spark.createDataFrame([(2, "7", 1.0, day(30)), (9, "9", 4.0, day(5)), (1, "x", 9.0, day(3))], schema.format("string"))
    earlier = spark.createDataFrame([(1, 7, 0.0, dt.date(1970, 1, 1)), (1, 6, 0.0, dt.date(1970, 1, 1)), (9, 5, 0.0, day(1))], schema.format("int"))
    caps = sales.build_caps(spark, shops, online, str(tmp_path / "caps"), [1, 2])
    assert rows(caps) == [(0, 9.0, 9.0), (7, 3.0, 3.0)]
    first = sales.build_first_sale(spark, shops, online, earlier, str(tmp_path / "first"), [1, 2])
    assert rows(first) == [(6, agg.NEVER_SOLD), (7, day(8)), (9, day(5))]


def test_table_refresh(spark, tmp_path):
    schema = "item int, loc int, price double, created_dttm int, is_actual string"
    raw, target = str(tmp_path / "raw"), str(tmp_path / "ods")
    append_table(spark.createDataFrame([(1, 1, 9.0, 2, "1"), (2, 1, 3.0, 2, "0")], schema), raw)
    append_table(spark.createDataFrame([(1, 1, 8.0, 1, "1"), (3, 1, 4.0, 1, "1")], schema), target)
    view = sales.refresh_table(spark, "item_loc", raw, target)
    assert rows(view, "item", "price") == [(1, 9.0), (3, 4.0)]
    assert read_table(spark, target).count() == 3


def test_ticket_days_are_reconciled(spark, inputs, tmp_path):
    raw, ods = str(tmp_path / "raw"), str(tmp_path / "ods")
    lines = inputs.ticket_lines().where(F.col("sell_date") < dt.date(1995, 6, 1))
    append_table(lines, raw)
    replace_partitions(agg.aggregate_ticket_lines(lines.where(F.col("sell_date") < dt.date(1995, 5, 1))), ods, ["sell_date"])
    got = sales.refresh_tickets(spark, raw, ods)
    assert rows(got, "sell_date", "item", "item_qty") == rows(
        agg.aggregate_ticket_lines(lines), "sell_date", "item", "item_qty")


def test_product_history_refresh(spark, inputs, tmp_path):
    path = str(tmp_path / "history")
    as_of = dt.datetime(2024, 2, 20)
    attributes, families = inputs.attribute_documents(), inputs.family_documents()
    first = shred_products(attributes, families, as_of, 30).withColumn("load_dttm", F.col("created_dttm"))
    append_table(first.where("1 = 0"), path)
    loaded = sales.refresh_product_history(spark, attributes, families, path, as_of, 30)
    assert loaded.count() == first.count()
    later = attributes.withColumns({c: F.col(c) + F.expr("interval 60 day") for c in ("stamp", "valid_from_dttm", "updated_dttm")})
    again = sales.refresh_product_history(spark, later, families, path, as_of + dt.timedelta(60), 40)
    per_item = again.groupBy("item").agg(
        F.sum((F.col("is_actual") == "1").cast("int")).alias("open"), F.count(F.lit(1)).alias("n"))
    assert per_item.where("open <> 1").count() == 0
    assert per_item.where("n = 2").count() > 0


def test_day_reload_equals_a_load_at_once(spark, inputs, tmp_path):
    tickets = inputs.tickets().where(F.col("sell_date") >= dt.date(2001, 4, 1)).withColumns({"item_qty_raw": F.col("item_qty"), "item_qty_processed": F.col("item_qty")})
    daily_path, calendar_path = str(tmp_path / "daily"), str(tmp_path / "calendar")
    today = dt.date(2001, 6, 1)
    replace_partitions(agg.agg_day_store_item(tickets.where(F.col("sell_date") < dt.date(2001, 5, 28))).repartition(4), daily_path, ["sell_date"])
    first_sale = agg.first_sale_date(inputs.sale_sources())
    got = sales.refresh_days(spark, tickets, first_sale, daily_path, calendar_path, today)
    seen = agg.agg_day_store_item(tickets.where(F.col("sell_date") <= today))
    want = densify_prices(seen, F.lit(today - dt.timedelta(7)), F.lit(today), first_sale)
    assert rows(got, *want.columns) == rows(want)


def test_weekly_rebuild_and_features_on_storage(spark, inputs, tmp_path):
    weekly_path, features_path = str(tmp_path / "weekly"), str(tmp_path / "features")
    daily = inputs.daily().where(F.col("sell_date") >= dt.date(2000, 1, 1))
    first_sale = agg.first_sale_date(inputs.sale_sources())
    whole = sales.basic_weekly(sales.rebuild_daily(daily, agg.load_bounds(
        spark.createDataFrame([], "week_num int"), daily, 12, dt.date(2000, 1, 3)), first_sale))
    last = whole.agg(F.max("week_num")).first()[0]
    replace_partitions(whole.where(F.col("week_num") <= last - 4).repartition(4), weekly_path, ["week_num"])
    got = sales.refresh_basic_marts(spark, daily, first_sale, weekly_path, features_path)
    stored = read_table(spark, weekly_path)
    assert stored.agg(F.max("week_num")).first()[0] == last
    newest = sorted(r[0] for r in got.select("week_num").distinct().collect())
    assert newest[-1] == last and newest[0] == last - 4 - 12 - 6
    want = sales.basic_features_by_item(stored).where(F.col("week_num") >= newest[0])
    columns = ["week_num", "item", "item_qty", "item_qty_prev_w1", "item_qty_next_w6", "item_qty_y", "smooth_item_qty_next_yw12"]
    assert rows(got, *columns) == rows(want, *columns)


def test_extended_marts_on_storage(spark, inputs, tmp_path):
    marts = sales.ExtendedMarts(str(tmp_path / "marts"))
    days = inputs.daily().where(F.col("sell_date") >= dt.date(2000, 6, 1))
    stock = inputs.stock().where(F.col("snapshot") >= dt.date(2000, 6, 1))
    replace_partitions(agg.agg_stock_by_store(stock.where(F.col("snapshot") < dt.date(2001, 6, 1))).repartition(4),
                       marts.path("stock_by_store"), ["week_num"])
    by_store = sales.refresh_stock_marts(spark, stock, days, marts, back=2)
    whole = agg.agg_stock_by_store(stock).where(F.col("week_num") <= agg.load_bounds(
        by_store, days, 2).first().max_week)
    assert by_store.count() == whole.count()
    attributes = hier.item_attr(inputs.item_master(), inputs.products())
    calendar = feat.week_calendar(hier.agg_tickets_by_store(days, inputs.item_dates(), attributes))
    sales.build_extended_marts(spark, days, inputs.item_dates(), attributes, by_store, inputs.exceptions(calendar), marts)
    features = read_table(spark, marts.path("features_by_item"))
    assert len(features.columns) == 4 + 5 + 90 + 125
    assert len(read_table(spark, marts.path("features_by_store")).columns) == 5 + 5 + 90 + 125
    assert features.count() > 0
    assert set(w for w, in rows(features, "week_num")).isdisjoint(w for w, in rows(inputs.exceptions(calendar), "week_num"))


def test_extended_marts_follow_a_changed_dictionary(spark, inputs, tmp_path):
    """Built twice: the second dictionary alone tells which weeks are left out and which values are blank."""
    marts = sales.ExtendedMarts(str(tmp_path / "marts"))
    days = inputs.daily().where(F.col("sell_date") >= dt.date(2000, 9, 1))
    stock = agg.agg_stock_by_store(inputs.stock().where(F.col("snapshot") >= dt.date(2000, 9, 1)))
    attributes = hier.item_attr(inputs.item_master(), inputs.products())
    calendar = feat.week_calendar(hier.agg_tickets_by_store(days, inputs.item_dates(), attributes))
    # A dictionary year hides values of its own weeks only, so both weeks lie well inside one.
    inside = sorted(w for w, in rows(calendar.where("year = 2001 AND week > 4"), "week_num"))[:9]

    def build(hidden):
        exceptions = calendar.where(F.col("week_num").isin(hidden)).select(
            "year", "week_num", (F.col("week_num") + 52).alias("next_week_num"))
        sales.build_extended_marts(spark, days, inputs.item_dates(), attributes, stock, exceptions, marts)
        wide = read_table(spark, marts.path("features_by_store"))
        return {(r.store, r.item, r.week_num): r for r in wide.select(
            "store", "item", "week_num", "avg_purchase_price",
            *[f"avg_purchase_price_{side}_w{n}" for side in ("prev", "next") for n in (1, 2, 3)]).collect()}

    first, second = build([inside[0]]), build([inside[6]])
    sold = {(r.store, r.item, r.week_num): r.sum_purchase_price / r.count_tickets
            for r in read_table(spark, marts.path("tickets_by_store")).collect()}
    assert first.keys() == {k for k in sold if k[2] != inside[0]}
    assert second.keys() == {k for k in sold if k[2] != inside[6]}
    for found, hidden in ((first, inside[0]), (second, inside[6])):
        for (store, item, week), r in found.items():
            assert r.avg_purchase_price == sold[store, item, week]
            for n in (1, 2, 3):
                for there, value in ((week - n, r[f"avg_purchase_price_prev_w{n}"]), (week + n, r[f"avg_purchase_price_next_w{n}"])):
                    assert value == (None if there == hidden else sold.get((store, item, there)))
