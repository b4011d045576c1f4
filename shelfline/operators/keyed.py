"""One row per business key: top rows per key and the incremental merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.sources.tables import current_view

# A key with more than this part of all rows is joined apart from the others.
HEAVY_PARTS = 1000

# Parts that the rows of such a key are dealt over where they are laid out by key, and the column that tells the part.
SPREAD = 64
DEAL = "_deal"


def top_n_by(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key.

    Spark limits each key inside every input task before the shuffle, so a key
    with very many rows sends only ``n`` per task onwards.
    """
    per_key = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(per_key))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def latest_by(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Latest row per key; the other columns, highest first, settle ties."""
    leading = order_by or []
    others = [name for name in df.columns if name not in keys and name not in leading]
    order = [F.col(name).desc_nulls_last() for name in [*leading, *others]]
    return top_n_by(df, keys, order or [F.lit(1)], 1)


def within_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate of a table is below its broadcast threshold."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def _frequent(counted: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Keys with more than one ``parts``-th of all rows, as columns ``_hot_...``."""
    sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    # The rows are counted by themselves: adding up ``sizes`` would shuffle the keys once more.
    return sizes.where(F.col("_rows") * parts > counted.agg(F.count(F.lit(1))).scalar()).select(
        *[F.col(key).alias(f"_hot_{key}") for key in keys])


def _same_key(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys])


def dealt_by(df: DataFrame, keys: list[str], by: list[str], tasks: int, counted: DataFrame,
             parts: int = HEAVY_PARTS) -> DataFrame:
    """Rows laid out by key over ``tasks``, of frequent keys also by the columns ``by``.

    ``counted`` gives the keys. Keys with more than one ``parts``-th of all rows are dealt
    over up to ``SPREAD`` parts by the hash of ``by``; the column ``DEAL`` tells the part, 0 for
    all other keys. Groupings by ``keys``, ``by`` and it stay where the rows are, and so do
    lookups by ``keys`` through ``heavy_join``, given the same ``counted`` and ``parts``.
    """
    hot = F.broadcast(_frequent(counted, keys, parts).withColumn("_is_hot", F.lit(True)))
    part = F.when(F.col("_is_hot"), F.pmod(F.xxhash64(*by), F.lit(SPREAD)).cast("int") + 1).otherwise(0)
    return df.join(hot, _same_key(keys), "left").select(*df.columns, part.alias(DEAL)).repartition(tasks, *keys, DEAL)


def heavy_join(df: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
               counted: DataFrame | None = None, parts: int = HEAVY_PARTS) -> DataFrame:
    """Join a lookup table of one row per key to rows of which one key may hold very many.

    The rows are counted by key. Keys with more than one ``parts``-th of all rows, fewer
    than ``parts`` in number, get their lookup rows by broadcast and then stay spread as
    their input tasks hold them, equal rows too; a missing key that is that frequent is
    one of them. All other rows meet their lookup row by key. ``counted`` may give the
    keys of ``df`` where that is cheaper to read. A lookup that Spark broadcasts by its
    size anyway needs none of this. Rows laid out by ``dealt_by`` stay where they are and keep
    their ``DEAL``: the lookup rows of frequent keys are repeated for each part.
    """
    if within_broadcast(lookup):
        return df.join(lookup, keys, how)
    values = [name for name in lookup.columns if name not in keys]
    counted = df if counted is None else counted
    heavy, same = _frequent(counted, keys, parts), _same_key(keys)
    if DEAL in df.columns:
        marked = lookup.join(F.broadcast(heavy.withColumn("_is_hot", F.lit(True))), same, "left")
        places = F.when(F.col("_is_hot"), F.sequence(F.lit(1), F.lit(SPREAD))).otherwise(F.array(F.lit(0)))
        return df.join(marked.select(*keys, *values, F.explode(places).alias(DEAL)), [*keys, DEAL], how)
    sides = lookup.select(*keys, F.struct(*values).alias("_found"))
    # Missing keys have no lookup row. Left out here and not by a plain equality, which Spark would
    # carry on to the counting and so count twice, with missing keys and without.
    known = sides.where(reduce(Column.__and__, [F.col(key).isNotNull() for key in keys]))
    held = known.join(F.broadcast(heavy), same, "left_semi")
    hot = heavy.join(F.broadcast(held), same, "left").select(
        *[f"_hot_{key}" for key in keys], F.col("_found").alias("_hot"), F.lit(True).alias("_is_hot"))
    marked = df.join(F.broadcast(hot), same, "left")
    # Heavy rows have their values: they are dealt by input task, which a repeated task deals alike.
    dealt = marked.withColumn("_deal", F.when(F.col("_is_hot"), F.spark_partition_id() + 1).otherwise(0))
    # Always 0, but not a constant that the optimizer would take out of the join's keys.
    plain = sides.withColumn("_deal", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int"))
    joined = dealt.join(plain, [*keys, "_deal"], "left")
    found = F.when(F.col("_is_hot"), F.col("_hot")).otherwise(F.col("_found"))
    if how == "inner":
        joined = joined.where(found.isNotNull())
    others = [name for name in df.columns if name not in keys]
    return joined.select(*keys, *others, *[found[name].alias(name) for name in values])


def map_increment(raw: DataFrame, columns: list[str], nk: Column | None = None,
                  mapping: dict[str, Column] | None = None) -> DataFrame:
    """An increment in the columns of its table: natural key built, columns rewritten."""
    fresh = raw.withColumn("nk", nk) if nk is not None else raw
    return fresh.select(*[(mapping or {}).get(name, F.col(name)).alias(name) for name in columns])


def merge_increment(raw: DataFrame, target: DataFrame, key: list[str],
                    order_by: str | None = None, nk: Column | None = None,
                    mapping: dict[str, Column] | None = None,
                    is_act: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Bring an increment into a table that holds one row per business key.

    Returns the new content and its current view. ``nk`` builds a missing natural
    key of the increment; ``mapping`` rewrites increment columns first. On equal
    ``order_by`` the increment wins over the table.
    """
    columns = target.columns
    both = (
        map_increment(raw, columns, nk, mapping).withColumn("_fresh", F.lit(1))
        .unionByName(target.withColumn("_fresh", F.lit(0)))
    )
    leading = [order_by, "_fresh"] if order_by else ["_fresh"]
    merged = latest_by(both, key, leading).select(*columns)
    return merged, current_view(merged, columns, is_act)
