"""Finding and reloading day partitions that differ from their source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.sources.tables import partition_counts


def partitions_to_reload(raw: DataFrame, ods: DataFrame, part: str,
                         group_keys: list[str] | None = None) -> DataFrame:
    """Partitions of ``raw`` that ``ods`` lacks or holds with another row count.

    ``group_keys`` counts distinct groups of the raw rows instead of rows, for
    an ``ods`` that keeps one row per group.
    """
    source = raw.select(*{part: None, **dict.fromkeys(group_keys)}).distinct() if group_keys else raw
    have = partition_counts(ods, part).withColumnRenamed("rows", "rows_ods")
    return (
        partition_counts(source, part).withColumnRenamed("rows", "rows_raw")
        .join(have, part, "left")
        .where(F.col("rows_ods").isNull() | (F.col("rows_raw") != F.col("rows_ods")))
    )


def reconcile_partitions(raw: DataFrame, ods: DataFrame, part: str,
                         aggregate: Callable[[DataFrame], DataFrame],
                         group_keys: list[str] | None = None) -> DataFrame:
    """Aggregated raw rows of all partitions to reload, ready to replace them.

    If ``part`` is a date, the list of partitions has at most one row per day of
    the calendar and is broadcast; for other types Spark decides by its size.
    """
    days = partitions_to_reload(raw, ods, part, group_keys).select(part)
    if isinstance(raw.schema[part].dataType, T.DateType):
        days = F.broadcast(days)
    return aggregate(raw.join(days, part, "left_semi"))
