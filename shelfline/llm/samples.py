"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(-1)).cast("int")


def picked_labels(labels: DataFrame, label: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """(id_, label) of at most ``rows`` ids outside the held-out fold: those with the least hashes, whatever the layout."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    return known.groupBy(F.col("doc_id").alias("id_")).agg(F.max(label).alias("label")).orderBy(F.xxhash64("id_"), "id_").limit(rows)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    rows: int) -> list[tuple[str, int]]:
    """At most ``rows`` (text, label) of documents outside the held-out fold, for the driver.

    The rows with the least hashes of their ids are taken, so the sample does not
    depend on the layout. Texts are whole, so the driver holds ``rows`` texts of whatever length.
    """
    picked = picked_labels(labels, label, folds, held_out, rows)
    # The picked ids are at most ``rows``: a side of known size.
    found = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), F.xxhash64("text").alias("key")).join(
        F.broadcast(picked), F.col("doc_id") == F.col("id_"))
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("text", "label"), "key").alias("s"))
    return [(r.text, int(r.label)) for r in one.orderBy("doc_id").select("s.text", "s.label").collect()]
