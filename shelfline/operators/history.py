"""Slowly changing dimension history with validity intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.keyed import top_n_by


def key_bounds(versions: DataFrame, key: str) -> DataFrame:
    """First start and last end of each key's versions."""
    last = F.max(F.struct("valid_from_dttm", "valid_to_dttm"))
    return versions.groupBy(key).agg(
        F.min("valid_from_dttm").alias("inc_from"), last["valid_to_dttm"].alias("inc_to"))


def scd2_merge(target: DataFrame, increment: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Bring new versions into a history.

    The result holds the new versions, the latest old version of each touched
    key closed around them, that key's versions closed before, and all versions
    of untouched keys; one row per key and start, the latest created winning,
    then the earliest updated.
    """
    columns = target.columns
    bounds = key_bounds(increment, key)
    second = F.expr("interval 1 second")
    start, end, known = F.col("valid_from_dttm"), F.col("valid_to_dttm"), F.col("inc_from").isNotNull()
    moved = {
        "valid_from_dttm": F.when(start >= F.col("inc_from"), F.col("inc_to") + second).otherwise(start),
        "valid_to_dttm": F.when(end <= F.col("inc_to"), F.col("inc_from") - second).otherwise(end),
        "updated_dttm": as_of,
        "is_actual": F.when(F.col("is_actual") == "1", F.lit("0")).otherwise(F.col("is_actual")),
    }
    kept = F.struct(F.lit(False).alias("_closing"), *columns)
    closing = F.struct(F.lit(True).alias("_closing"), *[moved.get(c, F.col(c)).alias(c) for c in columns])
    # An old row may stay, be closed, or both: one pass over the table says which.
    outcomes = F.array_compact(F.array(
        F.when(~known | (F.col("is_actual") == "0"), kept),
        F.when(known & (moved["valid_from_dttm"] < moved["valid_to_dttm"]), closing)))
    old = target.join(bounds, key, "left").select(F.inline(outcomes))
    rest = [F.col(c).desc_nulls_last() for c in columns if c not in (key, "valid_from_dttm")]
    closed = top_n_by(old.where("_closing"), [key], [start.desc(), *rest], 1)

    everything = (
        increment.select(*columns)
        .unionByName(closed.drop("_closing"))
        .unionByName(old.where("NOT _closing").drop("_closing"))
    )
    others = [F.col(c).desc_nulls_last() for c in columns
              if c not in (key, "valid_from_dttm", "created_dttm", "updated_dttm")]
    order = [F.col("created_dttm").desc_nulls_last(), F.col("updated_dttm").asc_nulls_last(), *others]
    return top_n_by(everything, [key, "valid_from_dttm"], order, 1)
