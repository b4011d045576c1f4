"""Mixing sources to target weights.

Words are summed per source, water-filled targets give each source a repetition
rate, and every document is emitted floor(rate) times, plus once more if a keyed
hash of its id falls below the fraction.

Defined cases: a null source is a source of its own, ranked last; null and empty
texts have size 0 and follow their source's rate; a source without any words has
rate 0, so its documents are not emitted; repeated rows decide alike (same id) and
each is emitted on its own; a null id is decided by its text; an empty table gives
an empty mix. Other columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import running_sums, table
from shelfline.session import materialize

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Targets share all words by weight; a target stops at ``ceiling`` times its
    source's size and the excess goes to the others. Sources are taken in order of
    the level at which they stop: one is stopped if the share it would have, with
    all before it stopped, is above its ceiling.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_sums(totals, [F.asc_nulls_last("source")], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighted = ranked.select("source", "source_size", weight.cast("long").alias("weight"))
    level = (F.col("source_size") / F.col("weight")).asc()
    filled = running_sums(weighted, [level, F.asc_nulls_last("source")],
                          {"words": F.col("source_size"), "shares": F.col("weight")})
    exact = "decimal(38,0)"
    left = F.col("words_all").cast(exact) - F.lit(ceiling) * (F.col("words") - F.col("source_size")).cast(exact)
    stopped = (left * F.col("weight").cast("decimal(10,0)")
               > (F.lit(ceiling) * F.col("source_size")).cast("decimal(25,0)")
               * (F.col("shares_all") - F.col("shares") + F.col("weight")).cast("decimal(12,0)"))
    filled = materialize(filled.withColumn("stopped", stopped), "targets")
    words, stop_words, shares = filled.agg(
        F.sum("source_size"), F.sum(F.when(F.col("stopped"), F.col("source_size"))),
        F.sum(F.when(~F.col("stopped"), F.col("weight")))).first()
    rest = float((words or 0) - ceiling * (stop_words or 0))
    return filled.select("source", "source_size", F.when(
        F.col("stopped"), F.col("source_size").cast("double") * ceiling).otherwise(
        F.lit(rest) * F.col("weight") / F.lit(float(shares or 1))).alias("target"))


def keyed_fraction(key: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the key and the seed only."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    """How often a document is emitted: the rate's whole part, and the rest by chance."""
    whole = F.floor(rate)
    return (whole + (keyed_fraction(key, seed) < rate - whole).cast("long")).cast("int")


def mix_plan(rows: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """Rows of (key, source, size, ...) with source_size, target and copies."""
    targets = materialize(source_targets(rows.select("source", "size"), weights, ceiling), "targets")
    named = targets.select(F.col("source").alias("source_"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # No hint: Spark broadcasts the targets while their files are small and else
    # splits the hot sources of a sorted join.
    return rows.join(named, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_").withColumn(
        "copies", copies(rate, F.col("key"), seed))


def mix(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """The mixed corpus: each document's row as often as its source's rate asks for."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"),
                       "source", word_count(F.col("text")).alias("size"))
    planned = mix_plan(rows, seed, weights, ceiling).where("copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    rows = materialize(docs.select("doc_id", key.alias("key"), "source", word_count(F.col("text")).alias("size")), "sizes")
    plan = mix_plan(rows)
    return plan.select("doc_id", "source", "size", "source_size", "target", "copies",
                       (F.col("size") * F.col("copies")).alias("taken"))


OP1_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM totals),
filled AS (
  SELECT *, sum(source_size) OVER () AS words_all, sum(weight) OVER () AS shares_all,
         coalesce(sum(source_size) OVER before, 0) AS words, coalesce(sum(weight) OVER before, 0) AS shares
  FROM weighted
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, (words_all - {CEILING} * words) * weight > {CEILING} * source_size * (shares_all - shares) AS stopped FROM filled),
rest AS (
  SELECT (sum(source_size) - {CEILING} * coalesce(sum(source_size) FILTER (stopped), 0))::DOUBLE AS words,
         coalesce(sum(weight) FILTER (NOT stopped), 1)::DOUBLE AS shares FROM marked),
targets AS (
  SELECT source, source_size,
         CASE WHEN stopped THEN source_size::DOUBLE * {CEILING} ELSE rest.words * weight / rest.shares END AS target
  FROM marked, rest),
planned AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, s.key,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
dealt AS (
  SELECT *, (floor(rate) + CASE WHEN ('0x' || substr(md5('{SEED}:' || key), 1, 13))::BIGINT / 4503599627370496.0
                                     < rate - floor(rate) THEN 1 ELSE 0 END)::INT AS copies
  FROM planned)
SELECT doc_id, source, size, source_size, target, copies, size * copies AS taken FROM dealt
"""
