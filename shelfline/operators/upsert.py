"""Tables laid out by key: batches are merged into the folders of their keys only."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.keyed import latest_by, map_increment
from shelfline.session import file_system, materialize, remove_path
from shelfline.sources.tables import folders, recover_table, replace_table, swap_partitions

# Column that keeps which batch a row came from; rows of the first load have none.
BATCH = "merged_batch"


class KeyedTable(NamedTuple):
    """A stored table of one row per key, in ``buckets`` folders by a hash of the key.

    The number of folders is part of their names and cannot change later. Choose it
    so that a folder fits one task, as a merge rewrites whole folders.
    """

    path: str
    schema: T.StructType
    key: tuple[str, ...]
    order_by: str | None = None
    buckets: int = 256

    @property
    def bucket(self) -> str:
        return f"bucket_of_{self.buckets}"

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows in the types of the table, with their folder."""
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema], BATCH)
        return typed.withColumn(self.bucket, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def stored(self, spark: SparkSession) -> DataFrame:
        """All stored columns, those of the layout included."""
        others = {name.partition("=")[0] for name in folders(spark, self.path) if "=" in name} - {self.bucket}
        if others:
            raise ValueError(f"{self.path} is laid out by {sorted(others)}, not by {self.bucket}")
        layout = [T.StructField(BATCH, T.StringType()), T.StructField(self.bucket, T.IntegerType())]
        return spark.read.schema(T.StructType([*self.schema.fields, *layout])).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.stored(spark).select(*self.schema.names)


def create_table(rows: DataFrame, table: KeyedTable) -> None:
    """Lay out the first load; of several rows of a key the latest stays."""
    newest = latest_by(rows.select(*table.schema.names), list(table.key), [table.order_by] if table.order_by else None)
    replace_table(table.placed(newest.withColumn(BATCH, F.lit(None).cast("string"))), table.path, [table.bucket])


def upsert(increment: DataFrame, table: KeyedTable) -> None:
    """Merge an increment; only the folders that hold one of its keys are read and replaced.

    The later ``order_by`` wins, then the later batch, then the increment over the
    table, then the other columns, highest first. So a batch that is merged again,
    also after a later one, changes nothing. The increment is first cut to one row
    per key, limited inside its input tasks; from there on all keys are of one size.
    Without a column ``merged_batch`` it counts as earlier than any batch.
    """
    if BATCH not in increment.columns:
        increment = increment.withColumn(BATCH, F.lit(None).cast("string"))
    spark, key = increment.sparkSession, list(table.key)
    leading = [table.order_by] if table.order_by else []
    fresh = table.placed(increment)
    newest = materialize(latest_by(fresh, [*key, table.bucket], [*leading, BATCH]), "newest")
    # At most one number per folder of the table.
    touched = sorted(row[0] for row in newest.select(table.bucket).distinct().collect())
    if not touched:
        return
    recover_table(spark, table.path)
    stored = table.stored(spark).where(F.col(table.bucket).isin(touched))
    both = newest.withColumn("_fresh", F.lit(1)).unionByName(stored.withColumn("_fresh", F.lit(0)))
    rest = [name for name in table.schema.names if name not in key and name not in leading]
    order = [F.col(name).desc_nulls_last() for name in [*leading, BATCH, "_fresh", *rest]]
    # Dealt by folder, which serves the ranking and the files alike.
    ranked = both.repartition(table.bucket).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(table.bucket, *key).orderBy(*order)))
    swap_partitions(ranked.where("_rank = 1").drop("_rank", "_fresh"), table.path, table.bucket)


# --------------------------------------------------------------------- batches

def add_batch(rows: DataFrame, raw_path: str, batch: str) -> None:
    """Deliver a batch; names sort as text in the order in which batches arrive."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"{batch!r} is no batch name")
    rows.write.mode("overwrite").parquet(f"{raw_path}/batch={batch}")


def consumed_batches(spark: SparkSession, raw_path: str) -> set[str]:
    """Batches on record as merged."""
    files, place = file_system(spark, f"{raw_path}/_consumed")
    return {f.getPath().getName() for f in files.listStatus(place)} if files.exists(place) else set()


def pending_batches(spark: SparkSession, raw_path: str) -> list[str]:
    """Batches wholly delivered and not on record as merged."""
    done = consumed_batches(spark, raw_path)
    names = [name.removeprefix("batch=") for name in folders(spark, raw_path) if name.startswith("batch=")]
    files, _ = file_system(spark, raw_path)
    return [name for name in names if name not in done
            and files.exists(file_system(spark, f"{raw_path}/batch={name}/_SUCCESS")[1])]


def record_consumed(spark: SparkSession, raw_path: str, batches: list[str]) -> None:
    """Put batches on record as merged and empty them; those recorded before are emptied too."""
    for name in batches:
        files, mark = file_system(spark, f"{raw_path}/_consumed/{name}")
        files.createNewFile(mark)
    done = consumed_batches(spark, raw_path)
    for name in folders(spark, raw_path):
        if name.startswith("batch=") and name.removeprefix("batch=") in done:
            remove_path(spark, f"{raw_path}/{name}")


def merge_batches(spark: SparkSession, raw_path: str, table: KeyedTable, nk: Column | None = None,
                  mapping: dict[str, Column] | None = None) -> list[str]:
    """Merge all pending batches at once, then put them on record; returns their names.

    A stop between the two merges them again at the next run, with the same result.
    A batch on record is never merged again, even if delivered anew.
    """
    names = pending_batches(spark, raw_path)
    if names:
        raw = spark.read.parquet(*[f"{raw_path}/batch={name}" for name in names])
        batch = F.regexp_extract(F.col("_metadata.file_path"), ".*/batch=([^/]*)/", 1)
        mapped = map_increment(raw.withColumn(BATCH, batch), [*table.schema.names, BATCH], nk, mapping)
        upsert(mapped, table)
    record_consumed(spark, raw_path, names)
    return names
