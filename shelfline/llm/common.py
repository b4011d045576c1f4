"""Steps that several operators share: ordered sums, components of links, sorted runs."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(written: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A written table of ids as a join's broadcast side if it has at most so many rows.

    Beyond that, some tens of MB, the join is left to Spark, which sorts both sides
    and splits skewed keys.
    """
    return F.broadcast(written) if written.count() <= rows else written


def in_small_batches(texts: DataFrame, rows: int = 1000) -> DataFrame:
    """The same rows, for functions over Arrow batches; whole texts call for batches of few rows.

    Lowers the session's setting if it is higher, as batches take memory outside the
    JVM's heap on both sides.
    """
    conf, name = texts.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))
    return texts


Batches = Iterator[pa.RecordBatch]


def frees_memory(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function over Arrow batches whose worker gives unused memory back when its task ends.

    Workers are kept for the next stage and would hold what the largest batch took.
    """
    def running(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return running


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, where ``value`` is worked out once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Each row with sums over the rows up to it (``name``) and over all rows (``name_all``).

    Rows are dealt by ranges of ``order`` and summed inside each range; only one
    row per range, as many as there are shuffle partitions, meets in one task.
    """
    placed = materialize(df.repartitionByRange(*order).withColumn("part_", F.spark_partition_id()), "ranges")
    parts = placed.groupBy("part_").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = parts.select(
        F.col("part_").alias("part_of_"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before_") for n in sums],
        *[F.sum(n).over(everything).alias(f"{n}_all") for n in sums])
    inside = Window.partitionBy("part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.select("*", *[F.sum(c).over(inside).alias(f"{n}_inside_") for n, c in sums.items()])
    return summed.join(offsets, F.col("part_") == F.col("part_of_")).select(
        *df.columns,
        *[(F.col(f"{n}_inside_") + F.col(f"{n}_before_")).alias(n) for n in sums],
        *[F.col(f"{n}_all") for n in sums])


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node reachable.

    Alternates two steps until every edge points at its root: each node passes its
    smallest neighbour to the larger neighbours, then to the smaller ones. Both are
    grouped minima and joins by node; edges never gather in one task.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.where("u > v").join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(
            F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
        edges = materialize(small.select("e.*").where("v <> u").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("links did not settle")
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that agree in ``keys``, from batches sorted by them."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        values = list(zip(*[rows.column(k).to_pylist() for k in keys], strict=True))
        start = 0
        for n, value in enumerate(values):
            if value != last:
                if n > start:
                    held.append(rows.slice(start, n - start))
                if held:
                    yield pa.concat_tables(held)
                held, start, last = [], n, value
        if len(values) > start:
            held.append(rows.slice(start))
    if held:
        yield pa.concat_tables(held)


def in_block_pairs(members: DataFrame, node: str, blocks: Column) -> DataFrame:
    """Copies of the members of large groups, so that any two meet under one (left_, right_).

    A group of one block stays whole; a larger one is cut into ``blocks`` by a hash of
    the node, and each pair of blocks is a task's worth of its own.
    """
    blocks = F.greatest(blocks.cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64(node), blocks).cast("int")
    return members.withColumn("own_", own).withColumn("other_", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        *members.columns, "own_", F.least("own_", "other_").alias("left_"), F.greatest("own_", "other_").alias("right_"))


def forest(linked: np.ndarray) -> np.ndarray:
    """Of a symmetric matrix of links, each row's smallest row reachable."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1))
        least = least[least]
        if (least == label).all():
            return label
        label = least
