"""Results stay right when one item holds a third of all rows."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline.operators import aggregates as agg
from shelfline.operators.asof import asof_join
from shelfline.operators import hierarchy as hier
from shelfline.operators.keyed import heavy_join, latest_by

HOT = 7


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(11)
    items = [HOT] * 4000 + [rng.randrange(100, 600) for _ in range(8000)]
    return pd.DataFrame({
        "item": items,
        "store": [rng.randrange(5) for _ in items],
        "sell_date": [dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(120)) for _ in items],
        "item_qty": [round(rng.lognormvariate(1, 2), 3) for _ in items],
        "total_cost": [float(rng.randrange(1, 100)) for _ in items],
        "online": [rng.random() < 0.4 for _ in items],
    })


def test_caps_of_a_hot_item(spark, lines):
    df = spark.createDataFrame(lines).repartition(16)
    got = {r.item: r for r in agg.outlier_caps(df.where("NOT online"), df.where("online")).collect()}
    assert set(got) == set(lines.item)
    for item, group in lines.groupby("item"):
        off, on = group[~group.online].item_qty, group[group.online].item_qty
        cap_off = np.quantile(off, 0.95) * 1.5 if len(off) > 10 else off.max() if len(off) else 0.0
        cap_on = np.quantile(on, 0.95) if len(on) > 10 else on.max() if len(on) else 0.0
        own = len(on) > 10 or len(on) >= len(off)
        assert got[item].item_qty_max_offline == pytest.approx(cap_off if len(off) >= len(on) else cap_on)
        assert got[item].item_qty_max_online == pytest.approx(cap_on if own else cap_off)


def test_capping_keeps_every_line(spark, lines):
    df = spark.createDataFrame(lines)
    caps = spark.createDataFrame([(HOT, 3.0)], "item bigint, item_qty_max_offline double")
    got = agg.cap_quantities(df, caps)
    assert got.count() == len(lines)
    assert got.where(F.col("item") == HOT).agg(F.max("item_qty_processed")).first()[0] == 3.0


@pytest.mark.parametrize("most", [10 ** 6, 10])
def test_asof_of_a_hot_item(spark, lines, most):
    df = spark.createDataFrame(lines).withColumn("day", F.unix_date("sell_date"))
    got = asof_join(df, df, ["item"], "day", {"total_cost": "before"}, strict=True, most=most).toPandas()
    assert len(got) == len(lines)
    best = lines.groupby(["item", "sell_date"]).total_cost.max().reset_index()
    best["sell_date"] = pd.to_datetime(best.sell_date)
    asked = lines.assign(sell_date=pd.to_datetime(lines.sell_date)).sort_values("sell_date")
    want = pd.merge_asof(asked, best.sort_values("sell_date"), on="sell_date", by="item",
                         allow_exact_matches=False, suffixes=("", "_before"))
    key = ["item", "day"]
    got["day"] = pd.to_datetime(got.sell_date)
    want["day"] = want.sell_date
    a = got.groupby(key).before.first().sort_index()
    b = want.groupby(key).total_cost_before.first().sort_index()
    pd.testing.assert_series_equal(a, b, check_names=False)


def test_latest_line_of_a_hot_item(spark, lines):
    df = spark.createDataFrame(lines).repartition(16)
    got = latest_by(df, ["item"], ["sell_date"])
    assert got.count() == lines.item.nunique()
    assert got.where(F.col("item") == HOT).first().sell_date == lines[lines.item == HOT].sell_date.max()


@pytest.fixture
def no_broadcast(spark):
    """No table counts as small, and no tasks are merged, so that their rows can be counted."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_task(df):
    return df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("parts", [3, 50, 10 ** 6])
def test_heavy_join_is_a_join(spark, no_broadcast, how, parts):
    df = spark.createDataFrame(
        [(1, n) for n in range(50)] + [(2, 0), (2, 0), (3, 1)] + [(None, n) for n in range(40)] + [(5, 1)] * 60, "k int, n int")
    lookup = spark.createDataFrame([(1, "a", 0.5), (3, "c", None), (4, "d", 1.0), (None, "e", 2.0)], "k int, v string, x double")
    assert rows(heavy_join(df, lookup, ["k"], how, parts=parts)) == rows(df.join(lookup, "k", how))
    empty = df.where("n < 0")
    assert heavy_join(empty, lookup, ["k"], how, parts=parts).count() == 0
    assert rows(heavy_join(df, lookup.where("k > 9"), ["k"], how, parts=parts)) == rows(df.join(lookup.where("k > 9"), "k", how))


def test_equal_lines_of_a_hot_item_are_spread(spark, no_broadcast):
    """A third of all lines is one and the same line, another third has no item."""
    line = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).cast("long")
    lines = spark.range(0, 30000, 1, 64).select(line.alias("item"), F.lit(1.0).alias("item_qty"))
    caps = spark.range(30000).select(F.col("id").alias("item"), F.lit(0.5).alias("item_qty_max_offline"))
    got = agg.cap_quantities(lines, caps)
    assert got.where("item_qty_processed = 0.5").count() == 20000
    plain = lines.join(caps, "item", "left")
    assert largest_task(plain) > 10000 and largest_task(got) < 8000


def test_a_model_of_nine_tenths_of_all_items_is_spread(spark, no_broadcast):
    """One week in which 90 % of the items are of model -1."""
    model = F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("-1")
    weekly = spark.range(0, 20000, 1, 64).select(
        F.lit(1).alias("year"), F.lit(1).alias("week"), F.lit(1).alias("week_num"), F.col("id").alias("item"),
        F.concat(F.lit("1|"), "id", F.lit("|3")).alias("dept_class_subclass"), model.alias("model"), F.lit(1.0).alias("q"))
    level = lambda name, key: weekly.select("week_num", key.alias(name)).distinct()
    by_class = level("dept_class", hier.class_key()).withColumn("avg_item_qty_by_class_scaled", F.lit(0.25))
    by_subclass = level("dept_class_subclass", F.col("dept_class_subclass")).withColumn("avg_item_qty_by_subclass_scaled", F.lit(0.5))
    by_model = level("model", F.col("model")).withColumn("avg_item_qty_by_model_scaled", F.when(F.col("model") == "-1", 0.75))
    got = hier.attach_level_averages(weekly, by_class, by_subclass, by_model)
    counts = dict(rows(got.groupBy("avg_item_qty_by_model_scaled").count()))
    assert counts == {0.75: 18000, None: 2000}
    assert got.where("avg_item_qty_by_class_scaled = 0.25 AND avg_item_qty_by_subclass_scaled = 0.5").count() == 20000
    assert largest_task(got) < 6000
