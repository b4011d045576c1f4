"""Embedding near-dedup by Euclidean p-stable hashing.

Normalised vectors are projected on random directions, shifted and cut into cells of
fixed width; the cells of several directions make a bucket, and many tables of
buckets are kept. Vectors that share a bucket are compared by exact cosine.

With cells of width 2, a pair at cosine 0.93 (distance 0.374) shares a cell in 85 % of
directions, hence one of 64 buckets of 14 directions with 99.9 %; unrelated vectors
share about one bucket in 400. Buckets report which of their vectors hang together; links
are then counted exactly inside each component.

Defined cases: a null label or vector, a zero vector and one with null or non-finite
components link with nothing and are components of their own; vectors of different
lengths are never linked; equal vectors of a label are worked on once and counted as
often as they occur; a null vec_id is linked but never names a component unless it
has no other; extra columns do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import components, forest, in_block_pairs, runs, table
from shelfline.llm.neardups import link_rows
from shelfline.llm.textbytes import GOLDEN, mixed
from shelfline.session import materialize

TABLES = 64
DIRECTIONS = 14
CELL = 2.0
COSINE = 0.93
SEED = 20
BUCKET_BLOCK = 1024
GROUP_BLOCK = 1024


def unit_rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) of the usable vectors, by their length."""
    column = batch.column("embedding")
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(int)
    values = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(int) if len(lengths) else lengths
    labelled = batch.column("label").is_valid().to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero((lengths == size) & labelled)
        vectors = values[starts[rows][:, None] + np.arange(size)[None, :]]
        largest = np.abs(vectors).max(axis=1, initial=0)
        usable = np.isfinite(vectors).all(axis=1) & (largest > 0)
        rows, vectors = rows[usable], vectors[usable] / largest[usable][:, None]
        if len(rows):
            yield rows, vectors / np.linalg.norm(vectors, axis=1)[:, None] + 0.0


def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, embedding) to the vector's key, its unit vector and its buckets."""
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        nodes: list[bytes | None] = [None] * batch.num_rows
        units: list[bytes | None] = [None] * batch.num_rows
        buckets: list[np.ndarray | None] = [None] * batch.num_rows
        labels = batch.column("label").to_pylist()
        for rows, vectors in unit_rows(batch):
            size = vectors.shape[1]
            if size not in known:
                draw = np.random.default_rng([SEED, size])
                known[size] = (draw.standard_normal((size, TABLES * DIRECTIONS)), draw.uniform(0, CELL, TABLES * DIRECTIONS))
            directions, shifts = known[size]
            for n in range(0, len(rows), 1024):
                part, some = vectors[n:n + 1024], rows[n:n + 1024]
                cells = np.floor((part @ directions + shifts) / CELL).astype(np.int64).view(np.uint64)
                cells = cells.reshape(len(part), TABLES, DIRECTIONS)
                group = np.array([int.from_bytes(hashlib.blake2b(f"{labels[r]}:{size}".encode(), digest_size=8).digest(), "little")
                                  for r in some], np.uint64)
                keys = mixed(group[:, None] + np.arange(1, TABLES + 1, dtype=np.uint64)[None, :] * GOLDEN)
                for k in range(DIRECTIONS):
                    keys = mixed(keys + (cells[:, :, k] + np.uint64(k)) * GOLDEN)
                for m, r in enumerate(some):
                    units[r] = part[m].tobytes()
                    nodes[r] = hashlib.blake2b(group[m].tobytes() + units[r], digest_size=16).digest()
                    buckets[r] = keys[m].view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(nodes, pa.binary()), pa.array(units, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
            names=["vec_id", "node", "unit", "buckets"])


def matrix(rows: pa.Table) -> np.ndarray:
    units = rows.column("unit").to_pylist()
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within each bucket, or pair of its blocks: vectors joined by links."""
    def found() -> Iterator[tuple[list[bytes], np.ndarray]]:
        for rows in runs(batches, ["bucket", "left_", "right_"]):
            if len(rows) > 1:
                vectors = matrix(rows)
                yield rows.column("node").to_pylist(), forest(vectors @ vectors.T >= COSINE)

    return link_rows(found())


def count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within each component, or pair of its blocks: how many vectors each one is linked with."""
    for rows in runs(batches, ["root", "left_", "right_"]):
        vectors = matrix(rows)
        own, left, right = (rows.column(c).to_numpy() for c in ("own_", "left_", "right_"))
        weights = rows.column("copies").to_numpy().astype(np.int64)
        linked = vectors @ vectors.T >= COSINE
        np.fill_diagonal(linked, False)
        if left[0] != right[0]:
            linked &= own[:, None] != own[None, :]
        yield pa.RecordBatch.from_arrays(
            [rows.column("node").combine_chunks(), pa.array(linked @ weights, pa.int64())], names=["node", "n_links"])


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Rows of (vec_id, label, embedding) to vec_id, n_links, component_id, kept."""
    hashed = materialize(vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding").mapInArrow(
        bucket, "vec_id long, node binary, unit binary, buckets array<long>"), "vectors")
    usable = hashed.where("node IS NOT NULL")
    copies = usable.groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    distinct = usable.select("node", "unit", "buckets").dropDuplicates(["node"])
    posted = distinct.select("node", F.explode("buckets").alias("bucket"))
    crowds = posted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = ["bucket", "left_", "right_"]
    placed = in_block_pairs(posted.join(crowds, "bucket"), "node", F.ceil(F.col("n") / BUCKET_BLOCK)).select("node", *keys)
    links = (placed.join(distinct.select("node", "unit"), "node").repartition(*keys).sortWithinPartitions(*keys)
             .mapInArrow(bucket_links, "a binary, b binary"))
    labels = components(links)
    members = labels.join(distinct.select("node", "unit"), "node").join(copies, "node")
    blocks = labels.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).alias("blocks"))
    keys = ["root", "left_", "right_"]
    compared = in_block_pairs(members.join(blocks, "root"), "node", F.col("blocks")).select("node", "unit", "copies", "own_", *keys)
    counts = (compared.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(count_links, "node binary, n_links long")
              .groupBy("node").agg(F.sum("n_links").alias("others")))
    rows = (hashed.select("vec_id", "node").join(copies, "node", "left").join(labels, "node", "left").join(counts, "node", "left")
            .select("vec_id", F.coalesce("root", "node").alias("component"),
                    (F.coalesce("others", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links")))
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("first_id"))
    return rows.join(least, "component", "left").select(
        "vec_id", "n_links", F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("first_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
