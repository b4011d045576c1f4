from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from shelfline.functions.scalars import natural_key, true_flag
from shelfline.operators.keyed import latest_by, merge_increment, top_n_by
from shelfline.plans.merges import MERGES, merge_table

SCHEMA = "k int, stamp int, v string, is_actual string"


def test_latest_row_per_key_and_ties(spark):
    df = spark.createDataFrame([(1, 1, "a", "1"), (1, 3, "b", "1"), (1, 3, "c", "0"), (2, None, "d", "1")], SCHEMA)
    assert rows(latest_by(df, ["k"], ["stamp"])) == [(1, 3, "c", "0"), (2, None, "d", "1")]


def test_top_n_limits_keys_before_the_shuffle(spark):
    df = spark.createDataFrame([(k, v) for k in range(3) for v in range(5)], "k int, v int").repartition(3)
    top = top_n_by(df, ["k"], [F.col("v").desc()], 2)
    assert rows(top) == [(k, v) for k in range(3) for v in (3, 4)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange hashpartitioning")[1]


def test_merge_prefers_newer_and_increment_on_ties(spark):
    target = spark.createDataFrame([(1, 5, "old", "1"), (2, 5, "old", "1"), (3, 5, "old", "0")], SCHEMA)
    raw = spark.createDataFrame([(1, 5, "new", "1"), (2, 4, "late", "1"), (4, 1, "new", "0")], SCHEMA)
    merged, current = merge_increment(raw, target, ["k"], "stamp", is_act="is_actual")
    assert rows(merged, "k", "v") == [(1, "new"), (2, "old"), (3, "old"), (4, "new")]
    assert rows(current, "k") == [(1,), (2,)]
    again, _ = merge_increment(raw, merged, ["k"], "stamp")
    assert rows(again) == rows(merged)


def test_merge_without_order_keeps_one_row_per_key(spark):
    target = spark.createDataFrame([("a", "b", 1)], "item_a string, item_b string, score int")
    raw = spark.createDataFrame([("a", "b", 0), ("a", "c", 3)], "item_a string, item_b string, score int")
    merged, _ = merge_table("item_pair_scores", raw, target)
    assert rows(merged) == [("a", "b", 0), ("a", "c", 3)]


def test_flags_are_mapped_before_the_merge(spark):
    schema = "k int, f string"
    target = spark.createDataFrame([(1, "1"), (2, "0")], schema)
    raw = spark.createDataFrame([(2, "t"), (3, "f")], schema)
    merged, _ = merge_increment(raw, target, ["k"], mapping={"f": true_flag(F.col("f"))})
    assert rows(merged) == [(1, "1"), (2, "1"), (3, "0")]


def test_natural_key_is_built_for_the_increment(spark):
    target = spark.createDataFrame([("1|x", 1, "x", 1)], "nk string, a int, b string, created_dttm int")
    raw = spark.createDataFrame([(1, "x", 2), (2, "y", 1)], "a int, b string, created_dttm int")
    merged, _ = merge_increment(raw, target, ["nk"], "created_dttm", nk=natural_key(F.col("a"), F.col("b")))
    assert rows(merged, "nk", "created_dttm") == [("1|x", 2), ("2|y", 1)]


def test_web_order_key_brings_stamps_to_one_layout(spark):
    columns = "nk string, id int, updatedat string, created_dttm int"
    target = spark.createDataFrame([], columns)
    raw = spark.createDataFrame([(7, "2024-02-03T04:05:06", 1), (7, "03.02.2024", 2)], "id int, updatedat string, created_dttm int")
    merged, _ = merge_table("web_orders", raw, target)
    assert rows(merged, "nk") == [("7|2024-02-03 00:00:00",)]


def test_every_listed_table_has_a_key():
    assert len(MERGES) == 24
    assert all(spec.key for spec in MERGES.values())
