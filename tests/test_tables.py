from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline import session
from shelfline.operators import aggregates as agg
from shelfline.operators.reconcile import partitions_to_reload, reconcile_partitions
from shelfline.sources import tables


def test_replace_a_table_that_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_table(spark.range(5), path)
    tables.append_table(spark.range(5, 6), path, ["id"])
    stored = tables.read_table(spark, path, ["id"])
    tables.replace_table(stored.where("id > 2"), path)
    assert rows(tables.read_table(spark, path)) == [(3,), (4,), (5,)]


def test_replacing_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partitions(spark.createDataFrame([(1, "a"), (2, "a")], "p int, v string"), path, ["p"])
    untouched = {f.name: f.read_bytes() for f in (tmp_path / "t" / "p=1").glob("*.parquet")}
    tables.replace_partitions(spark.createDataFrame([(2, "b"), (3, "b")], "p int, v string"), path, ["p"])
    assert rows(tables.read_table(spark, path, ["p", "v"])) == [(1, "a"), (2, "b"), (3, "b")]
    assert untouched == {f.name: f.read_bytes() for f in (tmp_path / "t" / "p=1").glob("*.parquet")}


def test_partitions_that_vanish_from_a_rebuilt_range_go(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.createDataFrame([(n, "a") for n in range(1, 6)], "p int, v string"), path, ["p"])
    tables.replace_range(spark.createDataFrame([(2, "b"), (4, "b")], "p int, v string"), path, "p", 2, 4)
    assert rows(tables.read_table(spark, path, ["p", "v"])) == [(1, "a"), (2, "b"), (4, "b"), (5, "a")]
    tables.replace_range(spark.createDataFrame([], "p int, v string"), path, "p", 4)
    assert rows(tables.read_table(spark, path, ["p", "v"])) == [(1, "a"), (2, "b")]
    tables.replace_table(spark.createDataFrame([(2, "c")], "p int, v string"), path, ["p"])
    assert rows(tables.read_table(spark, path, ["p", "v"])) == [(2, "c")]


def test_days_that_vanish_go(spark, tmp_path):
    path, day = str(tmp_path / "t"), lambda n: dt.date(2024, 1, n)
    tables.replace_table(spark.createDataFrame([(day(n), n) for n in (1, 2, 3)], "d date, v int"), path, ["d"])
    tables.replace_range(spark.createDataFrame([(day(3), 9)], "d date, v int"), path, "d", day(2), day(3))
    assert rows(tables.read_table(spark, path, ["d", "v"])) == [(day(1), 1), (day(3), 9)]


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="fails on purpose"):
        tables.replace_table(spark.range(9).select(F.raise_error(F.lit("fails on purpose")).cast("long").alias("id")), path)
    assert tables.read_table(spark, path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_scratch_tables_are_deleted_and_a_cluster_needs_a_folder(spark):
    table = session.materialize(spark.range(4), "short-lived")
    folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists() and session.clear_scratch(spark) >= 1 and not folder.exists()
    assert session.fallback_folder("local[4]") and session.fallback_folder("local")
    for master in ("local-cluster[2,1,1024]", "yarn", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.fallback_folder(master)


def test_incremental_dump_counts_and_formats(spark, tmp_path):
    df = spark.createDataFrame([(n, dt.datetime(2024, 1, n)) for n in range(1, 10)], "n int, at timestamp")
    for fmt, codec in (("parquet", "zstd"), ("json", "gzip"), ("csv", "none")):
        path = str(tmp_path / fmt)
        assert tables.incremental_dump(df, path, "at", dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 6), fmt, codec) == 3
        assert spark.read.format(fmt).load(path).count() == 3
    assert tables.incremental_dump(df, str(tmp_path / "all")) == 9


def test_export_projection_and_schema(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3, 4, 5, 600000))], "`a$b` short, at timestamp")
    assert rows(tables.export_projection(df)) == [(1, "2024-01-02 03:04:05")]
    assert tables.export_schema(df).schema.simpleString() == "struct<a_b:int,at:timestamp>"


def test_recent_rows(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 3, 9)], "at timestamp")
    assert tables.recent_rows(df, "at", dt.datetime(2024, 1, 10), 7).count() == 2


def day_counts(df):
    return df.groupBy("day", "k").agg(F.sum("q").alias("q"))


def test_only_differing_partitions_are_reloaded(spark):
    schema = "day date, k int, q int"
    a, b, c = (dt.date(2024, 1, n) for n in (1, 2, 3))
    raw = spark.createDataFrame([(a, 1, 1), (b, 1, 1), (b, 1, 2), (c, 1, 1)], schema)
    ods = spark.createDataFrame([(a, 1, 1), (b, 1, 3)], schema)
    assert rows(partitions_to_reload(raw, ods, "day")) == [(b, 2, 1), (c, 1, None)]
    assert rows(reconcile_partitions(raw, ods, "day", day_counts)) == [(b, 1, 3), (c, 1, 1)]
    # Counting groups, the summed partition is complete.
    assert rows(reconcile_partitions(raw, ods, "day", day_counts, ["k"])) == [(c, 1, 1)]


def test_partition_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "p int")
    assert rows(tables.partition_counts(df, "p")) == [(1, 2), (2, 1)]
    assert agg.max_by_key(df.withColumn("v", F.col("p") * 2), ["p"], "v", "m").count() == 2
