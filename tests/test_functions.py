from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline.functions import jsondocs, quantile, scalars, weeks
from shelfline.functions.cuts import with_stretches
from shelfline.functions.quantile import exact_quantile, value_slice


@pytest.mark.parametrize("day, number", [
    ("1970-01-01", 0), ("1970-01-04", 0), ("1970-01-05", 1), ("2018-01-01", 2505), ("2024-01-07", 2818),
    ("1969-12-28", -1),
])
def test_week_number(spark, day, number):
    df = spark.range(1).select(weeks.week_number(F.to_date(F.lit(day))).alias("n"))
    assert df.first().n == number


def test_week_columns_agree_with_calendar(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2015-12-20', DATE '2021-01-20')) AS day")
    for day, year, week, number in days.select("day", *weeks.week_columns(F.col("day"))).collect():
        monday = day - dt.timedelta(days=day.weekday())
        assert year == monday.year
        assert number == (monday - dt.date(1970, 1, 5)).days // 7 + 1
        last = dt.date(year - 1, 12, 31)
        assert week == (monday - (last - dt.timedelta(days=last.weekday()))).days // 7


def test_text_to_numbers(spark):
    df = spark.createDataFrame([("7",), ("255",), ("256",), ("65536",), ("-1",), ("1.5",), ("x",), ("99999999999",), (None,)], "t string")
    got = df.select(
        scalars.unsigned_or_null(F.col("t"), 8).cast("int").alias("a"),
        scalars.unsigned_or_null(F.col("t"), 16).alias("b"),
        scalars.int_or_zero(F.col("t")).alias("c")).collect()
    assert [r.a for r in got] == [7, 255, None, None, None, None, None, None, None]
    assert [r.b for r in got] == [7, 255, 256, None, None, None, None, None, None]
    assert [r.c for r in got] == [7, 255, 256, 65536, -1, 0, 0, 0, 0]


def test_timestamps_in_several_layouts(spark):
    texts = ["2024-02-03 04:05:06", "2024-02-03T04:05:06", "2024-02-03", "03.02.2024", "20240203", "no", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.to_date(scalars.parse_timestamp(F.col("t")))).collect()]
    assert got == [dt.date(2024, 2, 3)] * 5 + [None, None]


def test_keys_and_flags(spark):
    df = spark.createDataFrame([(1, "a", "t"), (2, None, "f"), (3, "c", None)], "n int, s string, f string")
    got = df.select(scalars.natural_key(F.col("n"), F.col("s")), scalars.true_flag(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [("1|a", "1"), (None, "0"), ("3|c", "0")]
    assert spark.range(1).select(scalars.key_prefix(F.lit("1|2|3"), 2)).first()[0] == "1|2"


def test_no_value_and_ratio(spark):
    df = spark.createDataFrame([(0.0,), (float("nan"),), (None,), (-2.0,), (3.0,)], "x double")
    got = df.select(scalars.no_value(F.col("x")), scalars.valid_price(F.col("x"))).collect()
    assert [r[0] for r in got] == [True, True, True, False, False]
    assert [r[1] for r in got] == [None, None, None, None, 3.0]
    assert spark.range(1).select(scalars.mean_of(F.lit(1.0), F.lit(0))).first()[0] is None


def test_slices_never_fall(spark):
    values = sorted([-1e9, -3.5, -1.0, -0.2, 0.0, 0.1, 0.5, 1.0, 2.0, 2.5, 1e3, 1e12])
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", value_slice(F.col("v")).alias("s"))
    slices = [r.s for r in df.orderBy("v").collect()]
    assert slices == sorted(slices)


def test_exact_quantile_agrees_with_numpy(spark):
    rng = random.Random(5)
    values = {f"k{k}": [rng.choice([rng.uniform(-50, 500), rng.randrange(20)]) for _ in range(rng.randrange(1, 400))]
              for k in range(12)}
    values["one"] = [4.0]
    values["hot"] = [float(rng.randrange(3)) for _ in range(5000)]
    lines = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k string, v double")
    counted = lines.groupBy("k", "v").count()
    for q in (0.0, 0.25, 0.95, 1.0):
        got = {r.k: r.out for r in exact_quantile(counted, ["k"], "v", "count", q, "out").collect()}
        assert got.keys() == values.keys()
        for k, vs in values.items():
            assert got[k] == pytest.approx(np.quantile(vs, q))


@pytest.mark.parametrize("kind", ["double", "decimal(20,6)"])
def test_exact_quantile_of_many_values_in_one_slice(spark, monkeypatch, kind):
    """100,000 distinct values within 4 %, one with half of the weight, next to small keys: cut again, still exact."""
    sorted_at_once = []

    def counting(*args):
        cut = with_stretches(*args)
        sorted_at_once.append(cut.groupBy("k", "_slice", args[-1]).count().agg(F.max("count")).first()[0])
        return cut

    monkeypatch.setattr(quantile, "with_stretches", counting)
    values = 1000 + 40 * np.random.default_rng(3).permutation(100_000) / 100_000
    weights = np.where(np.arange(100_000) == 17, 100_000, 1)
    counted = spark.createDataFrame(
        [("hot", float(v), int(w)) for v, w in zip(values, weights, strict=True)] + [("a", 1.0, 2), ("b", 5.0, 1), ("b", -5.0, 1)],
        "k string, v double, n long").withColumn("v", F.col("v").cast(kind))
    whole = np.sort(np.repeat(values, weights))
    for q in (0.0, 0.31, 0.95, 1.0):
        got = {r.k: r for r in exact_quantile(counted, ["k"], "v", "n", q, "out", most=2000).collect()}
        assert float(got["hot"].out) == pytest.approx(np.quantile(whole, q), abs=2e-6)
        assert got["hot"].rows == 199_999 and float(got["hot"].top) == pytest.approx(whole[-1])
        assert float(got["a"].out) == 1.0 and float(got["b"].out) == pytest.approx(-5 + 10 * q)
    assert len(sorted_at_once) == 4 and max(sorted_at_once) < 3000


def test_json_lists(spark):
    doc = '{"12963": ["name", "other"], "n": [17], "flat": "x"}'
    families = '[{"id": "a", "type": "STANDARD"}, {"id": "b", "type": "OTHER"}, {"id": "c", "type": "STANDARD"}]'
    df = spark.createDataFrame([(doc, families), ("broken", "[]"), (None, None)], "d string, f string")
    got = df.select(
        jsondocs.first_of_each(F.col("d"), ["12963", "n", "absent"]).alias("s"),
        jsondocs.first_of(F.col("d"), "12963").alias("one"),
        jsondocs.list_length(F.col("f")).alias("len"),
        jsondocs.ids_of_type(F.col("f"), "STANDARD").alias("ids")).collect()
    assert tuple(got[0].s) == ("name", "17", None) and got[0].one == "name"
    assert (got[0].len, got[0].ids) == (3, ["a", "c"])
    assert tuple(got[1].s) == (None, None, None) and (got[1].len, got[1].ids) == (0, [])
    assert got[2].len is None and got[2].ids is None
    assert rows(df.select(jsondocs.first_of(F.col("d"), "absent").alias("x"))) == [(None,)] * 3
