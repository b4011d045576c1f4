"""Tables on shared storage: scans, replacement, slices for export."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.scalars import wall_clock
from shelfline.session import file_system, remove_path


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Scan with an explicit column list, so that only those columns are read."""
    table = spark.read.format(fmt).load(path)
    return table.select(*columns) if columns else table


def append_table(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Add rows; with ``columns``, in that order."""
    (df.select(*columns) if columns else df).write.mode("append").parquet(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; ``target`` must not exist."""
    files, place = file_system(spark, source)
    if not files.rename(place, file_system(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders of a path, none if it does not exist."""
    files, place = file_system(spark, path)
    found = files.listStatus(place) if files.exists(place) else []
    return sorted(status.getPath().getName() for status in found if status.isDirectory())


def files_below(spark: SparkSession, path: str) -> dict[str, set[tuple[str, int]]]:
    """Name and write time of the files in each partition folder of a table."""
    files, _ = file_system(spark, path)
    return {
        name: {(f.getPath().getName(), f.getModificationTime())
               for f in files.listStatus(file_system(spark, f"{path}/{name}")[1])}
        for name in folders(spark, path) if "=" in name}


def leftovers(spark: SparkSession, path: str, state: str) -> list[str]:
    """Folders next to a table that a writer made: new, ready or old rows."""
    parent = path.rstrip("/").rpartition("/")[0]
    name = re.escape(path.rstrip("/").rpartition("/")[2])
    return [f"{parent}/{folder}" for folder in folders(spark, parent)
            if re.fullmatch(f"{name}-{state}-[0-9a-f]{{32}}", folder)]


def recover_table(spark: SparkSession, path: str) -> None:
    """Make a table whole after a writer that stopped half-way; a table has one writer at a time.

    Partitions that were complete are swapped in, an old folder that lost its place
    gets it back, and what is left of unfinished writes is deleted.
    """
    for ready in leftovers(spark, path, "ready"):
        swap_in(spark, ready, path)
    files, place = file_system(spark, path)
    for old in leftovers(spark, path, "old"):
        if files.exists(place):
            remove_path(spark, old)
        else:
            move(spark, old, path)
    for new in leftovers(spark, path, "new"):
        remove_path(spark, new)
    spark.catalog.refreshByPath(path)


def replace_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Replace all rows of a table, also when ``df`` was computed from it.

    The rows are written once, next to the table, which stays as it is until they
    are complete; then the two folders change places. If the new one cannot take
    its place, the old one is put back. ``by`` lays the table out in partitions, of
    which none of the old ones is left.
    """
    spark, token = df.sparkSession, uuid.uuid4().hex
    recover_table(spark, path)
    staged, old = f"{path}-new-{token}", f"{path}-old-{token}"
    writer = (df.hint("rebalance", *by).write.partitionBy(*by) if by else df.write)
    try:
        writer.parquet(staged)
    except Exception:
        remove_path(spark, staged)
        raise
    files, place = file_system(spark, path)
    had_rows = files.exists(place)
    if had_rows:
        move(spark, path, old)
    try:
        move(spark, staged, path)
    except Exception:
        if had_rows:
            move(spark, old, path)
        remove_path(spark, staged)
        raise
    if had_rows:
        remove_path(spark, old)
    spark.catalog.refreshByPath(path)


def swap_in(spark: SparkSession, ready: str, path: str) -> None:
    """Put the partitions of ``ready`` in place of the table's; an empty one only deletes.

    Every step can be repeated: a partition leaves ``ready`` when it has arrived.
    """
    files, place = file_system(spark, path)
    files.mkdirs(place)
    for name in folders(spark, ready):
        remove_path(spark, f"{path}/{name}")
        if files.listStatus(file_system(spark, f"{ready}/{name}")[1]):
            move(spark, f"{ready}/{name}", f"{path}/{name}")
    remove_path(spark, ready)


def swap_partitions(df: DataFrame, path: str, by: str,
                    cleared: Callable[[str], bool] = lambda name: False) -> None:
    """Replace the partitions that occur in ``df``, and delete those ``cleared`` names.

    The rows are written next to the table and marked ready in one rename. A stop
    before that leaves the table as it was, a stop after it is finished by
    ``recover_table`` or by the next writer.
    """
    spark, token = df.sparkSession, uuid.uuid4().hex
    recover_table(spark, path)
    staged, ready = f"{path}-new-{token}", f"{path}-ready-{token}"
    df.hint("rebalance", by).write.partitionBy(by).parquet(staged)
    written = set(folders(spark, staged))
    for name in folders(spark, path):
        if name not in written and cleared(name):
            files, empty = file_system(spark, f"{staged}/{name}")
            files.mkdirs(empty)
    move(spark, staged, ready)
    swap_in(spark, ready, path)
    spark.catalog.refreshByPath(path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace only the partitions that occur in ``df``.

    The rebalance hint brings a partition's rows together for few, large files
    and lets adaptive execution cut up a partition that is far too large.
    """
    (df.hint("rebalance", *by).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def replace_range(df: DataFrame, path: str, by: str, first: object, last: object = None) -> None:
    """Replace the partitions from ``first`` to ``last`` (open if None) by the rows of ``df``.

    Partitions of the range that get no rows are deleted; those outside it stay.
    The folders looked at are at most one per day or week of the range.
    """
    kind = df.schema[by].dataType

    def in_range(name: str) -> bool:
        column, _, text = name.partition("=")
        if column != by or text == "__HIVE_DEFAULT_PARTITION__":
            return False
        value = dt.date.fromisoformat(text) if isinstance(kind, T.DateType) else int(text)
        return value >= first and (last is None or value <= last)

    swap_partitions(df, path, by, in_range)


def current_view(df: DataFrame, columns: list[str], is_act: str | None = None) -> DataFrame:
    """Column view of a table, limited to current versions if it has a flag."""
    rows = df.where(F.col(is_act) == "1") if is_act else df
    return rows.select(*columns)


def between_bounds(df: DataFrame, bound: str, lower: object = None, upper: object = None) -> DataFrame:
    """Rows after ``lower`` up to and including ``upper``; a missing bound is open."""
    rows = df
    if lower is not None:
        rows = rows.where(F.col(bound) > F.lit(lower))
    if upper is not None:
        rows = rows.where(F.col(bound) <= F.lit(upper))
    return rows


def incremental_dump(df: DataFrame, path: str, bound: str | None = None, lower: object = None,
                     upper: object = None, fmt: str = "parquet", codec: str = "snappy") -> int:
    """Write a slice of the table and return its row count, in one job."""
    seen = Observation()
    rows = between_bounds(df, bound, lower, upper) if bound else df
    (rows.observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").format(fmt).option("compression", codec).save(path))
    return seen.get["rows"]


def resume_dump(df: DataFrame, path: str, bound: str, codec: str = "snappy") -> int:
    """Dump the rows after the last dump's upper bound up to the newest; returns their count.

    Every dump is a folder of its own, ``dump=0`` on; its bounds are kept in ``_bounds``
    once it is written, so a dump that failed is written again from the same lower
    bound. Rows without a bound are in no dump.
    """
    spark, kept = df.sparkSession, f"{path}/_bounds"
    schema = T.StructType([T.StructField("dump", T.IntegerType()), T.StructField("upper", df.schema[bound].dataType)])
    files, place = file_system(spark, kept)
    last = None
    if files.exists(place):
        last = spark.read.schema(schema).parquet(kept).orderBy(F.col("dump").desc()).first()
    number, lower = (last.dump + 1, last.upper) if last else (0, None)
    upper = between_bounds(df, bound, lower).agg(F.max(bound)).first()[0]
    if upper is None:
        return 0
    rows = incremental_dump(df, f"{path}/dump={number}", bound, lower, upper, codec=codec)
    spark.createDataFrame([(number, upper)], schema).coalesce(1).write.mode("append").parquet(kept)
    return rows


def export_projection(df: DataFrame) -> DataFrame:
    """All columns, timestamps as text like 2024-01-31 23:59:00."""
    def as_text(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return column

    return df.select(*[as_text(field) for field in df.schema])


def export_schema(df: DataFrame) -> DataFrame:
    """Names and types an external table accepts: no '$', no 16-bit integers."""
    def safe(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ShortType):
            column = column.cast("int")
        elif isinstance(field.dataType, (T.DayTimeIntervalType, T.TimeType)):
            column = column.cast("string")
        return column.alias(field.name.replace("$", "_"))

    return df.select(*[safe(field) for field in df.schema])


def partition_counts(df: DataFrame, by: str) -> DataFrame:
    """Row count per partition value."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))


def recent_rows(df: DataFrame, stamp: str, as_of: dt.datetime, days: int) -> DataFrame:
    """Rows stamped within ``days`` days before ``as_of``, or later."""
    return df.where(F.col(stamp) >= wall_clock(as_of - dt.timedelta(days=days), df.schema[stamp].dataType))
