from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfline.functions.exact import LIMIT, exact_mean, exact_sum
from shelfline.operators import hierarchy as hier


def results(df):
    return {r.k: (r.s, r.m) for r in df.groupBy("k").agg(
        exact_sum(F.col("v")).alias("s"), exact_mean(F.col("v")).alias("m")).collect()}


def values(seed):
    draw = random.Random(seed)
    return [(n % 5, draw.choice([None, draw.random(), 1 / draw.randint(1, 30), -draw.random() * 10 ** draw.randint(0, 9)]))
            for n in range(4000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_have_the_same_bits_in_any_order(spark, seed):
    data = values(seed)
    shuffled = random.Random(9).sample(data, len(data))
    want = results(spark.createDataFrame(data, "k int, v double").coalesce(1))
    assert want == results(spark.createDataFrame(shuffled, "k int, v double").repartition(7))
    assert want == results(spark.createDataFrame(shuffled[::-1], "k int, v double").repartition(211))
    for k, (total, mean) in want.items():
        own = [v for n, v in data if n == k and v is not None]
        assert math.isclose(total, math.fsum(own), rel_tol=1e-12, abs_tol=1e-9) and mean == total / len(own)


def test_sums_without_or_beyond_numbers(spark):
    data = [(1, None), (2, math.inf), (2, 1.0), (3, math.nan), (4, LIMIT * 4), (4, 1.0), (5, 0.5), (5, None)]
    got = {k: s for k, (s, _) in results(spark.createDataFrame(data, "k int, v double")).items()}
    assert got[1] is None and got[2] == math.inf and math.isnan(got[3]) and got[4] == LIMIT * 4 + 1 and got[5] == 0.5


def test_level_means_do_not_depend_on_partitions(spark):
    draw = random.Random(3)
    data = [(2000, w, 1500 + w, i, f"1|{i % 3}|{i % 7}", "-1" if i % 9 else None, draw.random())
            for w in range(4) for i in range(700)]
    df = spark.createDataFrame(data, "year int, week int, week_num int, item int, dept_class_subclass string, model string, "
                                     "avg_item_qty_scaled_with_stock double")
    for level in hier.LEVELS:
        found = {tuple(sorted(tuple(map(str, r)) for r in hier.avg_by_level(df.repartition(n), level).collect())) for n in (1, 8, 211)}
        assert len(found) == 1


def test_sums_of_values_that_count_several_times(spark):
    data = [(k, v, n % 4) for n, (k, v) in enumerate(values(3))]
    df = spark.createDataFrame(data, "k int, v double, n int")
    repeated = results(df.selectExpr("k", "v", "explode(array_repeat(0, n))"))
    got = df.groupBy("k").agg(exact_sum(F.col("v"), F.col("n")).alias("s"), exact_mean(F.col("v"), F.col("n")).alias("m"))
    assert {r.k: (r.s, r.m) for r in got.collect()} == repeated
