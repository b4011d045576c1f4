"""Sharding by jump consistent hashing, with DataFrame functions only.

A key jumps forward through the shard numbers by a keyed random sequence; the last
stop below the shard count is its shard. With one more shard only the keys whose
next stop is exactly that shard move, and they move there.

Defined cases: a null text counts as empty; a null key is replaced by a hash of the
text; rows that repeat a key get the same shard and different slots; an empty table
gives an empty result. Extra columns do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import let, table
from shelfline.session import materialize

SHARDS = 16
# Fixed value: the multiplier of the published generator, in digits of 21, 21 and 22 bits.
MULTIPLIER = 2862933555777941757
DIGITS = [(MULTIPLIER >> (21 * n)) & ((1 << 21) - 1 if n < 2 else (1 << 22) - 1) for n in range(3)]


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a 64-bit key.

    The generator's state is kept in three digits of 21, 21 and 22 bits, since
    64-bit products that wrap around are errors under ANSI arithmetic.
    """
    low, top = F.lit((1 << 21) - 1), F.lit((1 << 22) - 1)
    first = F.struct(
        key.bitwiseAND(low).alias("d0"), F.shiftrightunsigned(key, 21).bitwiseAND(low).alias("d1"),
        F.shiftrightunsigned(key, 42).bitwiseAND(top).alias("d2"),
        F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("stop"))

    def step(s: Column, _: Column) -> Column:
        a = s["d0"] * DIGITS[0] + 1
        b = s["d0"] * DIGITS[1] + s["d1"] * DIGITS[0] + F.shiftright(a, 21)
        last = (s["d1"] * DIGITS[2] + s["d2"] * DIGITS[1]).bitwiseAND(F.lit(1))  # all of it that 64 bits hold
        c = (s["d0"] * DIGITS[2] + s["d1"] * DIGITS[1] + s["d2"] * DIGITS[0] + F.shiftright(b, 21)
             + F.shiftleft(last, 21))
        d1, d2 = b.bitwiseAND(low), c.bitwiseAND(top)
        draw = F.shiftleft(d2, 9) + F.shiftright(d1, 12) + 1
        moved = F.struct(
            a.bitwiseAND(low).alias("d0"), d1.alias("d1"), d2.alias("d2"), s["stop"].alias("shard"),
            F.floor((s["stop"] + 1).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double"))).alias("stop"))
        return F.when(s["stop"] < shards, moved).otherwise(s)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, first, step, lambda s: s["shard"].cast("int"))


def key_hash(key: Column, text: Column) -> Column:
    return F.coalesce(F.when(key.isNotNull(), F.xxhash64(key)), F.xxhash64(text))


def gapless(rows: DataFrame, shard: str, order: list[Column], slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0.

    A shard is numbered piece by piece: a piece holds the shard's rows of one input
    split, so that no window is larger than a split, whatever keys repeat. The
    pieces' offsets come from their counts.
    """
    placed = materialize(rows.withColumn("split_", F.spark_partition_id()), "shards")
    before = Window.partitionBy(shard).orderBy("split_").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(shard, "split_").agg(F.count(F.lit(1)).alias("n_")).select(
        F.col(shard).alias("shard_"), F.col("split_").alias("piece_"), F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("from_"))
    within = Window.partitionBy(shard, "split_").orderBy(*order)
    numbered = placed.withColumn("within_", F.row_number().over(within) - 1)
    return numbered.join(counts, (F.col(shard) == F.col("shard_")) & (F.col("split_") == F.col("piece_"))).select(
        *rows.columns, (F.col("from_") + F.col("within_")).alias(slot))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    key = key_hash(F.col("doc_id"), text)
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), let(key, lambda k: jump_hash(k, SHARDS)).alias("shard"),
        let(key, lambda k: jump_hash(k, SHARDS + 1)).alias("grown_shard"))
    return gapless(rows, "shard", [F.asc_nulls_last("doc_id"), F.col("text_crc32"), F.col("size")])
