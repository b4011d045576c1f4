"""Tables are laid out by key once, over tasks counted from the lines, and exact sums are added up as longs."""

from __future__ import annotations

import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline.functions.exact import LIMIT, exact_sum
from shelfline.operators import aggregates as agg
from shelfline.operators import clustering, keyed
from shelfline.operators import features as feat
from shelfline.operators import hierarchy as hier
from shelfline.operators.densify import densify_prices
from shelfline.plans import inputs, queries, sales

LINES = 240


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Ticket lines, some without store, item or quantity, and the articles they are of."""
    rng, at = random.Random(5), str(tmp_path_factory.mktemp("layout"))
    odd = lambda value: None if rng.random() < 0.05 else value
    spark.createDataFrame(
        [(n // 3, odd(rng.randrange(20)), odd(rng.randrange(12)), dt.datetime(1998, 1, 1) + dt.timedelta(rng.randrange(60)),
          odd(float(rng.randrange(1, 50))), odd(rng.randrange(9999) / 100), odd(rng.choice("RAN"))) for n in range(LINES)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp_ntz, l_quantity double, "
        "l_extendedprice double, l_returnflag string").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame(
        [(n, f"Brand#{n % 3}", n % 5, "PROMO" if n % 4 == 0 else "SMALL") for n in range(20)],
        "p_partkey bigint, p_brand string, p_size int, p_type string").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame(
        [(n, dt.datetime(1997, 12, 1)) for n in range(LINES // 3)],
        "o_orderkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{at}/orders.parquet")
    return at


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(inputs, "LINES_PER_TASK", 40)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_follow_the_lines(spark, folder, small_tasks):
    assert inputs.Inputs(spark, folder).tasks() == LINES // 40 + 1
    assert inputs.Inputs(spark, folder).daily().rdd.getNumPartitions() == 7


def test_weeks_and_features_of_daily_sales_need_one_shuffle(spark, folder, small_tasks):
    i = inputs.Inputs(spark, folder)
    weekly = agg.smooth(agg.agg_week_store_item(i.daily()), ["store", "item"], "item_qty", "smooth_item_qty")
    assert plan(weekly).count("Exchange hashpartitioning") == 1
    plain = agg.agg_day_store_item(i.tickets().withColumns({"item_qty_raw": F.col("item_qty"), "item_qty_processed": F.col("item_qty")}))
    assert rows(i.daily()) == rows(plain)


def test_stock_is_shuffled_once_by_store_and_once_by_week(spark, folder, small_tasks):
    found, i = queries.all_queries()["agg_stock_by_week"](spark, folder), inputs.Inputs(spark, folder)
    assert plan(found).count("Exchange hashpartitioning") == 2 and found.rdd.getNumPartitions() == 7
    want = agg.agg_stock_by_week(agg.agg_stock_by_store(i.stock()))
    assert rows(found) == rows(queries.rounded(want)) and found.dtypes == want.dtypes


def test_caps_counted_in_given_tasks(spark, folder):
    i = inputs.Inputs(spark, folder)
    shops, online = i.tickets().where("NOT online"), i.tickets().where("online")
    assert rows(agg.outlier_caps(shops, online, tasks=5)) == rows(agg.outlier_caps(shops, online))


def test_dense_days_over_given_tasks(spark, folder):
    i = inputs.Inputs(spark, folder)
    first, last = F.lit(dt.date(1998, 1, 10)), F.lit(dt.date(1998, 2, 20))
    sold = agg.first_sale_date(i.sale_sources())
    got = densify_prices(i.daily(), first, last, sold, tasks=5)
    assert got.rdd.getNumPartitions() == 5
    assert rows(got) == rows(densify_prices(i.daily(), first, last, sold))


def test_scaled_weeks_over_given_tasks(spark, folder):
    i = inputs.Inputs(spark, folder)
    tickets, stock = queries._store_weeks(i), queries._stock_weeks(i)
    # A stock record that comes twice counts twice, however the rows are laid out.
    stock = stock.unionByName(stock.where("item < 5"))
    got = hier.avg_scaled_with_stock(tickets, stock, 5)
    assert got.rdd.getNumPartitions() == 5
    assert rows(got) == rows(hier.avg_scaled_with_stock(tickets, stock))


@pytest.mark.parametrize("name", ["features_v2_masked", "features_v2_store_masked", "features_v2_year", "features_v2_store_year"])
def test_masked_features_write_no_wide_rows_between(spark, folder, monkeypatch, name):
    written, real = [], queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, mart: written.append(mart) or real(df, mart))
    assert queries.all_queries()[name](spark, folder).count() > 0
    assert sorted(written) == ["level-means", "level-means", "level-means", "scaled-weeks", "store-weeks"]


def test_exact_sums_are_added_up_as_longs(spark):
    df = spark.createDataFrame([(1, 0.5)], "k int, v double").groupBy("k").agg(exact_sum(F.col("v")).alias("s"))
    assert "19,0" not in plan(df)


def test_exact_sums_near_the_limit(spark):
    draw = random.Random(8)
    data = [(n % 3, draw.choice([-1, 1]) * draw.choice([LIMIT * (1 - 2.0 ** -53), LIMIT / 3, 2.0 ** -40, draw.random()])) for n in range(900)]
    df = spark.createDataFrame(data, "k int, v double").repartition(7)
    for k, s in rows(df.groupBy("k").agg(exact_sum(F.col("v")))):
        own = [Fraction(v) for n, v in data if n == k]
        parts = [(math.floor(v * 2 ** 20), math.floor((v * 2 ** 20 - math.floor(v * 2 ** 20)) * 2 ** 43)) for v in own]
        assert s == float(sum(p for p, _ in parts)) / 2.0 ** 20 + float(sum(r for _, r in parts)) / 2.0 ** 63


@pytest.mark.parametrize("name", ["attr_by_week", "attr_by_store"])
def test_attributes_stay_in_counted_tasks_and_are_the_same_without_broadcasts(spark, folder, small_tasks, monkeypatch, name):
    want = rows(queries.all_queries()[name](spark, folder))
    monkeypatch.setattr(keyed, "within_broadcast", lambda df: False)
    found = queries.all_queries()[name](spark, folder)
    assert found.rdd.getNumPartitions() == 7 and sorted(map(str, rows(found))) == sorted(map(str, want))


def test_vectors_are_dealt_over_counted_tasks(spark, monkeypatch):
    monkeypatch.setattr(clustering, "ITEMS_PER_TASK", 10)
    weekly = spark.range(45).selectExpr("id AS item", "CAST(id % 3 AS INT) AS week_num", "CAST(id AS DOUBLE) AS value")
    _, vectors = clustering._best_model(weekly, "value", "week_num", 2, 1, 2, 0.01, 0)
    assert vectors.rdd.getNumPartitions() == 5 and vectors.count() == 45


def test_masked_lookups_leave_the_slices_alone(spark):
    rows_of = spark.createDataFrame([(2000, w, 1565 + w, 1, *[float(w)] * 5) for w in range(1, 40)],
                                    f"year int, week int, week_num int, item int, {', '.join(f'{m.column} double' for m in feat.BY_ITEM)}")
    exceptions = spark.createDataFrame([(2000, 1575, 1627)], "year int, week_num int, next_week_num int")
    got = feat.masked_features(rows_of, feat.week_calendar(rows_of), exceptions, ["item"], feat.BY_ITEM, feat.EXTENDED_REACH)
    assert "transform(_w#" not in got._jdf.queryExecution().optimizedPlan().toString()
    plain = feat.mask_exceptions(feat.week_and_year_features(
        rows_of, feat.week_calendar(rows_of), ["item"], feat.BY_ITEM, feat.EXTENDED_REACH), exceptions, feat.BY_ITEM, feat.EXTENDED_REACH)
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(plain.select(*got.columns))))


def test_basic_features_deal_the_weeks_once(spark, folder, small_tasks):
    found = queries.all_queries()["features_v1"](spark, folder)
    assert plan(found).count("REPARTITION_BY_NUM") == 1
    i = inputs.Inputs(spark, folder)
    weekly = queries.rounded(sales.basic_weekly(i.daily()))
    assert rows(found) == rows(queries.rounded(sales.basic_features_by_item(weekly)))


def test_scaled_weeks_are_laid_out_once(spark):
    tickets = spark.createDataFrame(
        [(2000, 1, w, s, i, "1|2|A", "3", float(q)) for w, s, i, q in [
            (1, 1, 5, 4), (1, 2, 5, 6), (2, 1, 5, 8), (2, 2, 5, 3), (None, 1, 5, 8), (1, None, 5, 2), (1, 1, None, 9), (3, 1, 5, 0)]],
        "year int, week int, week_num int, store int, item bigint, dept_class_subclass string, model string, week_item_qty double")
    # Twice a record of one store week, records without a key, and one without sales.
    stock = spark.createDataFrame(
        [(1, 1, 5), (1, 1, 5), (1, 2, 5), (2, 1, 5), (None, 1, 5), (1, None, 5), (1, 1, None), (3, 1, 5), (9, 9, 9)],
        "week_num int, store short, item bigint")
    found = hier.avg_scaled_with_stock(tickets, stock, 3)
    assert plan(found).count("Exchange hashpartitioning") == 1
    assert rows(found, "week_num", "item", "avg_item_qty_scaled_with_stock") == sorted(
        [(1, 5, (2 * 0.5 + 1.0) / 3), (2, 5, 1.0), (None, 5, None), (1, None, None), (3, 5, 0.0)], key=repr)
    assert rows(found) == rows(hier.avg_scaled_with_stock(tickets, stock))


def test_frequent_keys_are_counted_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "within_broadcast", lambda df: False)
    spark.range(300).selectExpr("nullif(id % 7, 0) AS k", "nullif(id % 3, 0) AS j", "id AS n").write.parquet(f"{tmp_path}/rows")
    spark.range(-1, 6).selectExpr("nullif(id, -1) AS k", "id % 2 AS j", "id * 10 AS v").write.parquet(f"{tmp_path}/lookup")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df, lookup = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("rows", "lookup"))
        found = keyed.heavy_join(df, lookup, ["k", "j"], parts=15)
        # The other use of the count takes over what the first one has shuffled.
        assert plan(found).count("+- Exchange hashpartitioning(k") == 1 and "ReusedExchange" in plan(found)
        want = [(k or None, j or None, n, k * 10 if k and j and k < 6 and k % 2 == j else None)
                for n in range(300) for k, j in [(n % 7, n % 3)]]
        assert rows(found) == sorted(want, key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
