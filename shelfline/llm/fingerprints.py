"""Document fingerprints: threshold-scaled sketches, with DataFrame functions only.

A text's sketch keeps every hash of its five-word shingles below a fixed fraction of
the hash range, and always its least one, so that a text with words never has an
empty sketch. Sketches of parts merge into the sketch of the whole (``merged``), and
the share of the smaller one found in the larger estimates containment however
unequal the documents are. Texts of few words keep few hashes, so their estimates are
coarse; equal texts have likeness 1 at every length.

Defined cases: a null text is an empty text; a text of one to four words is one
shingle; a text without words has an empty sketch, which equals another empty one
(likeness 1) and nothing else (0). In the query, rows with the same doc_id count as
one place in the order of documents: their next document is the one with the next
larger id (null ids last), and of several texts with that id the one with the
smallest sha256. With a single id, a document's next document is itself. Repeated
shingles and repeated rows count once and each; very long texts are hashed whole, by
functions over one array per text. Extra columns do no harm; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import let, running_sums, table
from shelfline.session import materialize

WIDTH = 5
KEPT_BITS = 3
BOUND = -(1 << 63) + (1 << (64 - KEPT_BITS))
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "".join(chr(c) for c in range(65, 91))


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the word shingles of a text, A-Z lower-cased, in order, with repeats."""
    words = F.filter(F.split(F.translate(text, UPPER, UPPER.lower()), SPACES), lambda w: w != "")

    def of(h: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(h) - width),
                            lambda i: F.xxhash64(*[F.get(h, i + n) for n in range(width)]))
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(F.size(h) < width, F.array(F.xxhash64(h))).otherwise(every))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def kept(hashes: Column) -> Column:
    """Of shingle hashes, sorted and distinct, those below the bound; the least one if there is none."""
    below = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < BOUND)))
    return let(below, lambda found: F.when(
        (F.size(found) > 0) | (F.size(hashes) == 0), found).otherwise(F.array(F.array_min(hashes))))


def sketch(text: Column) -> Column:
    """The hashes that a text's sketch keeps."""
    return let(shingles(text), kept)


def merged(a: Column, b: Column) -> Column:
    """The sketch of all shingles that two sketches stand for."""
    return let(F.concat(a, b), kept)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the smaller sketch's shingles that the other has too."""
    least = F.least(F.size(a), F.size(b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when(least == 0, F.lit(0.0))
            .otherwise(F.size(F.array_intersect(a, b)) / least))


def fingerprint(one: Column) -> Column:
    """The sketch as text: its hashes in hexadecimal digits."""
    return F.array_join(F.transform(one, lambda h: F.hex(h)), ".")


def next_ids(lengths: DataFrame) -> DataFrame:
    """(doc_id, next_id, longest) in ascending order of distinct ids, the last followed by the first."""
    ids = lengths.groupBy("doc_id").agg(F.max("n_chars").alias("longest"))
    placed = materialize(running_sums(ids, [F.asc_nulls_last("doc_id")], {"place": F.lit(1)}), "places")
    after = placed.select(F.col("doc_id").alias("next_id"), F.col("place").alias("next_place"))
    return placed.join(after, F.pmod(F.col("place"), F.col("place_all")) + 1 == F.col("next_place")).select(
        "doc_id", "next_id", "longest")


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = materialize(next_ids(docs.select("doc_id", F.length("text").alias("n_chars"))), "order").select(
        F.col("doc_id").alias("before_id"), "next_id", "longest")
    # Both joins lay the texts out by doc_id; Spark writes that shuffle once and reads it twice.
    sent = docs.join(order, F.col("doc_id").eqNullSafe(F.col("next_id"))).groupBy("before_id").agg(F.min_by(
        F.struct(F.expr("substring(text, 1, longest div 4)").alias("head"), sketch(F.col("text")).alias("next_sketch")),
        F.sha2("text", 256)).alias("sent"))
    joined = docs.join(sent, F.col("doc_id").eqNullSafe(F.col("before_id")))
    edited = F.expr("concat(substring(text, 1, n_chars - n_chars div 4), substring(sent.head, 1, n_chars div 4))")
    texts = joined.withColumn("n_chars", F.length("text")).select(
        "doc_id", "n_chars", "text", edited.alias("edited"), "sent.next_sketch")
    sketched = texts.select(
        "doc_id", F.col("n_chars").cast("long"), F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("changed"), "next_sketch")
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_sketch")).alias("near_next"))
