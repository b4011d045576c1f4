"""MinHash near-dedup by an inverted join of signature coordinates.

1. A document's set holds its distinct five-word shingles; documents with equal sets
   form one class. A class is signed by the least value of each of 48 hash functions.
2. Classes are posted under coordinate-value pairs. Only pairs that occur twice can
   match, and of a class's pairs only its rarest are posted: two classes with at least
   24 matches share one of their 25 rarest pairs (prefix filter).
3. The classes of a posting list are compared by signature. Lists report which of
   their classes hang together, not the pairs; those joined form candidate groups.
4. The full sets of each candidate group are compared exactly; the confirmed links
   give the components.

Large lists and groups are cut into blocks, and each pair of blocks is compared in a
task of its own. Two sets that are just similar enough (0.75) miss 24 of 48 matches
with a chance of about 1 in 20,000; everything else is exact.

Defined cases: null and empty texts have empty sets and are alone; a text of one to
four words is one shingle; rows with a null id link like others and are never
dropped; repeated rows are equal texts; extra columns do no harm; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import components, forest, frees_memory, in_block_pairs, in_small_batches, runs, small_side, table
from shelfline.llm.textbytes import GOLDEN, WordHasher, mixed, shingle_set
from shelfline.session import materialize

WIDTH = 5
COORDINATES = 48
MATCHES = 24
PERCENT = 75
LIST_BLOCK = 1024
GROUP_BLOCK = 512
BLOCK_SHINGLES = 4_000_000
ROWS_OUT = 20_000


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return np.array([mixed(shingles + GOLDEN).sum(), mixed(shingles ^ GOLDEN).sum()], np.uint64).tobytes()


def minima(shingles: np.ndarray, odd: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set, in pieces of bounded size."""
    least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for n in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[None, n:n + 4096] * odd[:, None] + plus[:, None]).min(axis=1))
    return least


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, text) to the set's size, key, coordinate-value pairs and short signature."""
    hasher = WordHasher()
    seeds = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * GOLDEN)
    odd, plus = seeds[:COORDINATES] | np.uint64(1), seeds[COORDINATES:]
    top = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(56)
    for batch in batches:
        sizes, keys, tokens, short = [], [], [], []
        for words in hasher.of_texts(batch.column("text")):
            shingles = shingle_set(words, WIDTH)
            sizes.append(len(shingles))
            if not len(shingles):
                keys.append(None), tokens.append(None), short.append(None)
                continue
            least = minima(shingles, odd, plus)
            keys.append(set_key(shingles))
            tokens.append((top | (least >> np.uint64(8))).view(np.int64))
            short.append((least >> np.uint64(32)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(tokens, pa.list_(pa.int64())), pa.array(short, pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "node", "tokens", "short"])


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (node, shingles as bytes)."""
    hasher = WordHasher()
    for batch in batches:
        keys, packed, held = [], [], 0
        for words in hasher.of_texts(batch.column("text")):
            shingles = shingle_set(words, WIDTH)
            if len(shingles):
                keys.append(set_key(shingles))
                packed.append(shingles.tobytes())
                held += len(packed[-1])
            if held > 32_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], names=["node", "shingles"])
                keys, packed, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], names=["node", "shingles"])


def link_rows(found: Iterator[tuple[list[bytes], np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(a, b) for each node that does not stand for itself."""
    a, b = [], []
    for nodes, label in found:
        for n in np.flatnonzero(label != np.arange(len(label))):
            a.append(nodes[n])
            b.append(nodes[label[n]])
        if len(a) >= ROWS_OUT:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def list_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within each posting list, or pair of its blocks: classes that hang together by matches."""
    def found() -> Iterator[tuple[list[bytes], np.ndarray]]:
        for rows in runs(batches, ["token", "left_", "right_"]):
            if len(rows) < 2:
                continue
            short = np.frombuffer(b"".join(rows.column("short").to_pylist()), np.uint8).reshape(len(rows), COORDINATES)
            matches = np.zeros((len(rows), len(rows)), np.uint8)
            for n in range(COORDINATES):
                matches += short[:, n][:, None] == short[:, n][None, :]
            yield rows.column("node").to_pylist(), forest(matches >= MATCHES)

    return link_rows(found())


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: shingles found in several sets, counted piece by piece."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    several = np.diff(np.append(starts, len(values))) > 1
    column = np.cumsum(several) - 1
    column = np.where(several, column, -1)[np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))]
    owner, column = owner[column >= 0], column[column >= 0]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    step = 4096
    cuts = np.searchsorted(column, np.arange(0, int(several.sum()) + step, step))
    for n in range(len(cuts) - 1):
        here = slice(cuts[n], cuts[n + 1])
        part = np.zeros((len(sets), step), np.float32)
        part[owner[here], column[here] - n * step] = 1
        counts += part @ part.T
    return counts


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within each candidate group, or pair of its blocks: classes joined by links that hold on full sets."""
    def found() -> Iterator[tuple[list[bytes], np.ndarray]]:
        for rows in runs(batches, ["root", "left_", "right_"]):
            sets = dict(zip(rows.column("node").to_pylist(), rows.column("shingles").to_pylist(), strict=True))
            if len(sets) < 2:
                continue
            arrays = [np.frombuffer(s, np.uint64) for s in sets.values()]
            sizes = np.array([len(s) for s in arrays], float)
            both = shared_counts(arrays)
            yield list(sets), forest(100 * both >= PERCENT * (sizes[:, None] + sizes[None, :] - both))

    return link_rows(found())


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, root): classes that may be linked, directly or through others, share a root."""
    tokens = classes.select("node", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = tokens.join(counts, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("ranked"))
    rarest = ranked.where(F.size("ranked") >= MATCHES).select(
        "node", F.slice("ranked", F.lit(1), F.size("ranked") - (MATCHES - 1)).alias("rarest"))
    posted = rarest.join(classes.select("node", "short"), "node").select("node", "short", F.explode("rarest").alias("p")).select(
        "node", "short", "p.token", "p.n")
    keys = ["token", "left_", "right_"]
    lists = in_block_pairs(posted, "node", F.ceil(F.col("n") / LIST_BLOCK)).select("node", "short", *keys)
    links = lists.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(frees_memory(list_links), "a binary, b binary")
    return components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of (doc_id, text) to doc_id, text_key, n_shingles, component_id, kept and chosen.

    ``kept`` marks the ids that stand for their component; ``chosen`` marks one text
    of it, should an id have several.
    """
    keyed = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text"))
    signed = materialize(keyed.mapInArrow(
        sign, "doc_id long, text_key long, n_shingles long, node binary, tokens array<long>, short binary"), "signed")
    classes = signed.where("node IS NOT NULL").select("node", "tokens", "short").dropDuplicates(["node"])
    groups = candidate_groups(classes)
    members = materialize(signed.join(groups, "node").groupBy("root", "node").agg(
        F.min("doc_id").alias("rep_id"), F.first("n_shingles").alias("n_shingles")), "members")
    sizes = members.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / GROUP_BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks"))
    # Whole texts stay where they are while the ids looked for are few.
    wanted = keyed.select("doc_id", "text").join(small_side(members.select("rep_id")), F.col("doc_id").eqNullSafe(F.col("rep_id")), "left_semi")
    sets = wanted.select("text").mapInArrow(frees_memory(full_sets), "node binary, shingles binary")
    keys = ["root", "left_", "right_"]
    placed = in_block_pairs(members.join(sizes, "root").select("node", "root", "blocks"), "node", F.col("blocks"))
    compared = sets.join(placed, "node").select("node", "shingles", *keys)
    links = compared.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(frees_memory(confirm), "a binary, b binary")
    labels = components(links)
    rows = signed.select("doc_id", "text_key", "n_shingles", "node").join(labels, "node", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("root", "node").alias("component"))
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"))
    return rows.join(least, "component", "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(F.col("first").isNull(), F.lit(True)).otherwise(F.col("text_key") == F.col("first.text_key")).alias("chosen"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one row of each component; all columns, and all documents without words, stay."""
    marks = materialize(near_duplicates(docs).groupBy("doc_id", "text_key").agg(
        F.bool_and(F.col("kept") & F.col("chosen")).alias("stays_"), F.count(F.lit(1)).alias("rows_"),
        F.max("n_shingles").alias("size_")).where("NOT stays_ OR (rows_ > 1 AND size_ > 0)").select(
        F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"), "stays_"), "marks")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_")
    marked = docs.select(row, F.col("doc_id").alias("doc_id_"), F.xxhash64("text").alias("text_key_")).join(
        small_side(marks), F.col("doc_id_").eqNullSafe(F.col("id_")) & (F.col("text_key_") == F.col("key_")), "left")
    once = marked.where("stays_ IS NULL").select("row_.*")
    repeated = marked.where("stays_").dropDuplicates(["id_", "key_"]).select("row_.*")
    return once.unionByName(repeated)


def op10_minhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
