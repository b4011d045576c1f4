"""Removal of long repeated byte strings by suffix sorting, bucket by bucket.

Which strings of ``length`` bytes occur more than once is a question about suffixes in
order, down to that depth. Suffixes are sorted in buckets that can be dealt to tasks:
of the short strings (grams) inside a window of ``length`` bytes the one of least hash,
the first of equal ones, names the bucket. Equal windows have the same least gram at
the same place, so they meet in one bucket. Neighbouring windows of one bucket are
kept as one stretch of text. Three steps:

1. Every text posts the hashes of its stretches. Stretches that occur again as a whole
   are repeated from end to end; a bucket with one kind of stretch holds no more.
2. Of the other buckets each kind of stretch is copied once, and the suffixes of many
   buckets are sorted together by bucket-pointer refinement: first by bucket, place
   and the first bytes, then over and over by the identifier of the bucket that the
   suffix further on has come to, which doubles the depth; suffixes alone in their
   bucket leave, and so do those whose continuation has left. What still shares a
   bucket at the full depth is repeated. Bytes are compared, not hashes.
3. Every text cuts its stretches again, marks the repeated parts and drops them.

A bucket with more than HOT kinds is refined by Spark itself: each of its windows gets
the identifier of its suffix at the full depth, a hash, and identifiers are counted.

Only first and last repeated window of a stretch are kept, as any two windows of a
stretch touch. Hashes of 64 bits tell stretches apart inside a bucket, which has a
64-bit name of its own.

Defined cases: null and empty texts have no strings and stay empty; texts shorter than
``length`` stay whole; repeated rows (same id and text) repeat each other and lose all
that is long enough; null ids are told apart by their texts; very long texts are cut in
blocks, and a text of one repeated character posts each kind of stretch once; extra
columns are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import in_small_batches, small_side, table
from shelfline.llm.textbytes import GOLDEN, mixed
from shelfline.session import materialize

LENGTH = 400
GRAM = 32
BLOCK = 1 << 19
HOT = 4096
SORTED_BYTES = 2_000_000
FIRST_BYTES = 8
LAST = (1 << 63) - 1
POSTED = "place long, text_key long, bucket long, kind long, n long"
COPIED = "place long, text_key long, bucket long, kind long, single boolean, anchor int, bytes binary"
WINDOWS = "place long, text_key long, bucket long, kind long, single boolean, at int, suffix long"
MARKS = "place long, text_key long, kind long, a int, b int"


class Cutter:
    """Cuts texts into stretches of windows that share their least gram."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM) -> None:
        if not FIRST_BYTES <= gram < length:
            raise ValueError(f"need {FIRST_BYTES} <= gram < length")
        self.length, self.gram, self.block = length, gram, max(BLOCK, 4 * length)
        odd, size = int(GOLDEN) | 1, self.block + length
        self.powers = np.cumprod(np.full(size, odd, np.uint64))
        self.back = np.cumprod(np.full(size, pow(odd, -1, 1 << 64), np.uint64))
        self.codes = mixed(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
        self.low = np.uint64((1 << int(size).bit_length()) - 1)

    def blocks(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(text numbers, where each part starts in its text, bytes, where each part ends in them); long texts come alone."""
        group: list[int] = []
        size = 0

        def joined():
            data = np.frombuffer(b"".join(texts[n] for n in group), np.uint8)
            return np.array(group), np.zeros(len(group), np.int64), data, np.cumsum([len(texts[n]) for n in group])

        for n, text in enumerate(texts):
            if len(text) < self.length:
                continue
            if group and size + len(text) > self.block:
                yield joined()
                group, size = [], 0
            if len(text) > self.block:
                for shift in range(0, len(text) - self.length + 1, self.block):
                    part = np.frombuffer(text, np.uint8, min(self.block + self.length - 1, len(text) - shift), shift)
                    yield np.array([n]), np.array([shift]), part, np.array([len(part)])
                continue
            group.append(n)
            size += len(text)
        if group:
            yield joined()

    def stretches(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(part, begin, end, anchor, bucket, kind) of each stretch of the parts of a block, and running sums of the bytes."""
        n, width = len(data), self.length - self.gram + 1
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.codes[data] * self.powers[:n])))
        grams = mixed((sums[self.gram:] - sums[:-self.gram]) * self.back[:n - self.gram + 1])
        # The least hash, then the first place: a window's choice does not depend on where the window lies.
        ranked = grams & ~self.low | np.arange(len(grams), dtype=np.uint64)
        padded = np.full(-(-len(ranked) // width) * width, np.iinfo(np.uint64).max)
        padded[:len(ranked)] = ranked
        rows = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(rows, axis=1).ravel()
        least = (np.minimum(ahead[:n - self.length + 1], behind[width - 1:width + n - self.length]) & self.low).astype(np.int64)
        sizes = np.diff(np.concatenate(([0], ends)))
        part = np.repeat(np.arange(len(ends)), sizes)[:len(least)]
        whole = np.arange(len(least)) + self.length <= ends[part]
        change = np.append(True, least[1:] != least[:-1])
        first = np.flatnonzero(whole & (change | np.append(True, ~whole[:-1])))
        last = np.flatnonzero(whole & np.append(change[1:] | ~whole[1:], True))
        end, anchor = last + self.length, least[first]
        bucket = grams[anchor]
        kind = mixed((sums[end] - sums[first]) * self.back[first] ^ (end - first).astype(np.uint64) * GOLDEN) ^ mixed(bucket)
        return part[first], first, end, anchor, bucket, kind, sums

    def suffix_ids(self, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
        return mixed((sums[at + self.length] - sums[at]) * self.back[at])


def as_bytes(values: pa.Array) -> list[bytes]:
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in values]


def record(schema: str, *columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, k)
         for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def owners(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("place").to_numpy(), batch.column("text_key").to_numpy()


def post(cutter: Cutter, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, text_key, text) to each kind of stretch of a text and how often it occurs there."""
    for batch in batches:
        places, keys = owners(batch)
        for number, _, data, ends in cutter.blocks(as_bytes(batch.column("text"))):
            part, _, _, _, bucket, kind, _ = cutter.stretches(data, ends)
            _, one, n = np.unique(mixed(part.astype(np.uint64) * GOLDEN) ^ kind, return_index=True, return_counts=True)
            owner = number[part[one]]
            yield record(POSTED, places[owner], keys[owner], bucket[one], kind[one], n)


def wanted_stretches(cutter: Cutter, batch: pa.RecordBatch) -> Iterator[tuple]:
    """(text numbers, bytes, begin, end, anchor, bucket, kind, single, sums) of the stretches that rows list in ``kinds``."""
    lists = batch.column("kinds")
    listed, flat = lists.offsets.to_numpy(), lists.flatten()
    kinds, single = flat.field("kind").to_numpy().view(np.uint64), flat.field("single").to_numpy(zero_copy_only=False)
    listed = listed - listed[0]
    row = np.repeat(np.arange(len(batch)), np.diff(listed))
    known = mixed(row.astype(np.uint64) * GOLDEN) ^ kinds
    order = np.argsort(known)
    known, single = known[order], single[order]
    for number, _, data, ends in cutter.blocks(as_bytes(batch.column("text"))):
        part, begin, end, anchor, bucket, kind, sums = cutter.stretches(data, ends)
        name = mixed(number[part].astype(np.uint64) * GOLDEN) ^ kind
        slot = np.minimum(np.searchsorted(known, name), len(known) - 1)
        # Once each: a kind may occur in several places of its text.
        _, one = np.unique(name, return_index=True)
        some = one[known[slot[one]] == name[one]]
        yield number[part[some]], data, begin[some], end[some], anchor[some], bucket[some], kind[some], single[slot[some]], sums


def copy(cutter: Cutter, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, text_key, text, kinds) to the bytes of the stretches listed."""
    for batch in batches:
        places, keys = owners(batch)
        for number, data, begin, end, anchor, bucket, kind, single, _ in wanted_stretches(cutter, batch):
            sizes = end - begin
            places_in = np.concatenate(([0], np.cumsum(sizes)))
            taken = data[np.repeat(begin - places_in[:-1], sizes) + np.arange(places_in[-1])]
            values = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(places_in.astype(np.int32)), pa.py_buffer(taken)])
            yield record(COPIED, places[number], keys[number], bucket, kind, single, anchor - begin, values)


def windows(cutter: Cutter, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows to each window of the stretches, with the identifier of its suffix at the full depth."""
    for batch in batches:
        places, keys = owners(batch)
        for number, _, begin, end, _, bucket, kind, single, sums in wanted_stretches(cutter, batch):
            many = end - begin - cutter.length + 1
            of = np.repeat(np.arange(len(begin)), many)
            at = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            yield record(WINDOWS, places[number[of]], keys[number[of]], bucket[of], kind[of], single[of], at,
                         cutter.suffix_ids(sums, begin[of] + at))


def refine(data: np.ndarray, begin: np.ndarray, anchor: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """Places where a string of ``length`` bytes starts that another stretch of the bucket has at the same place of its anchor.

    ``begin``: where each stretch starts in ``data``, with the end; ``bucket``: small numbers.
    """
    size = len(data)
    room = np.repeat(begin[1:], np.diff(begin)) - np.arange(size)
    column = np.arange(size) - np.repeat(begin[:-1] + anchor, np.diff(begin)) + length
    shift = np.int64(int(2 * size).bit_length())
    active = np.flatnonzero(room >= FIRST_BYTES)
    word = np.zeros(len(active), np.uint64)
    for k in range(FIRST_BYTES):
        word = word << np.uint64(8) | data[active + k].astype(np.uint64)
    _, word = np.unique(word, return_inverse=True)
    spread = np.repeat(bucket, np.diff(begin))[active] * (2 * length + 1) + column[active]
    keys = spread << shift | word
    pointer, alive, depth = np.zeros(size, np.int64), np.zeros(size, bool), FIRST_BYTES
    while True:
        _, name, many = np.unique(keys, return_inverse=True, return_counts=True)
        shared = many[name] > 1
        active, name = active[shared], name[shared]
        alive[:] = False
        alive[active] = True
        pointer[active] = name
        if depth == length or not len(active):
            return active
        step = min(depth, length - depth)
        depth += step
        active = active[room[active] >= depth]
        active = active[alive[active + step]]
        keys = pointer[active] << shift | pointer[active + step]


def sort_buckets(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """COPIED rows, ordered by bucket and kind, to the repeated part of each single stretch."""
    def done(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        buckets, kinds = rows.column("bucket").to_numpy(), rows.column("kind").to_numpy()
        # Equal rows of documents post a stretch twice; it is one kind.
        keep = np.append(True, (buckets[1:] != buckets[:-1]) | (kinds[1:] != kinds[:-1]))
        rows = rows.filter(pa.array(keep))
        values = rows.column("bytes").combine_chunks()
        values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
        offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
        data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        begin = offsets - offsets[0]
        _, bucket = np.unique(buckets[keep], return_inverse=True)
        found = refine(data, begin, rows.column("anchor").to_numpy().astype(np.int64), bucket, length)
        of = np.searchsorted(begin, found, side="right") - 1
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1])[:len(of)])
        last = np.append(first[1:], len(of)) - 1 if len(first) else first
        of = of[first]
        a, b = found[first] - begin[of], found[last] - begin[of] + length
        single = rows.column("single").to_numpy(zero_copy_only=False)[of]
        names = [rows.column(c).to_numpy()[of][single] for c in ("place", "text_key", "kind")]
        return record(MARKS, *names, a[single], b[single])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column("bytes").nbytes
        if size < SORTED_BYTES:
            continue
        rows = pa.Table.from_batches(held)
        keys = rows.column("bucket").to_numpy()
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if len(change):
            whole = int(change[-1]) + 1
            yield done(rows.slice(0, whole))
            held = rows.slice(whole).to_batches()
            size = sum(b.column("bytes").slice(0).nbytes for b in held)
    if held:
        yield done(pa.Table.from_batches(held))


def repeated_marks(docs: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """(place, text_key, kind, a, b): the repeated part of each kind of stretch of a text, counted from its start."""
    cutter = Cutter(length, gram)
    owner = ["place", "text_key"]
    posted = materialize(docs.mapInArrow(lambda b: post(cutter, b), POSTED), "stretches")
    kinds = materialize(posted.groupBy("bucket", "kind").agg(
        F.sum("n").alias("n"), F.min(F.struct(*owner)).alias("at")), "stretch-kinds")
    # The buckets with several kinds are written, so that the join below is one of two plain shuffles.
    several = materialize(kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "buckets")
    open_ = materialize(kinds.join(several, "bucket").select(
        "at.*", "bucket", "kind", (F.col("n") == 1).alias("single"), (F.col("m") > hot).alias("hot")), "open-kinds")

    def listed(kind_rows: DataFrame) -> DataFrame:
        lists = materialize(kind_rows.groupBy(*owner).agg(F.collect_list(F.struct("kind", "single")).alias("kinds")), "stretches-wanted")
        return docs.join(small_side(lists.select(*owner)), owner, "left_semi").join(lists, owner)

    copied = listed(open_.where("NOT hot")).mapInArrow(lambda b: copy(cutter, b), COPIED)
    marks = copied.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(lambda b: sort_buckets(length, b), MARKS)
    if not open_.where("hot").isEmpty():
        every = materialize(listed(open_.where("hot")).mapInArrow(lambda b: windows(cutter, b), WINDOWS), "hot-windows")
        shared = materialize(every.groupBy("bucket", "suffix").agg(
            F.count_distinct("kind").alias("n")).where("n > 1").select("bucket", "suffix"), "shared-suffixes")
        marks = marks.unionByName(every.where("single").join(shared, ["bucket", "suffix"]).groupBy(*owner, "kind").agg(
            F.min("at").alias("a"), (F.max("at") + length).cast("int").alias("b")))
    whole = posted.join(kinds.where("n > 1").select("bucket", "kind"), ["bucket", "kind"]).select(
        *owner, "kind", F.lit(0).alias("a"), F.lit(np.iinfo(np.int32).max).alias("b"))
    return marks.unionByName(whole)


def without(cutter: Cutter, texts: pd.Series, kinds: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
    """Each text's bytes without the marked parts of its stretches, and the runs removed."""
    data = [t.encode() if t is not None else b"" for t in texts]
    marked = [n for n, k in enumerate(kinds) if k is not None and len(k)]
    kept: list[bytes] = list(data)
    spans: list[list[dict]] = [[] for _ in data]
    if marked:
        row = np.repeat(np.arange(len(marked)), [len(kinds[n]) for n in marked])
        known = mixed(row.astype(np.uint64) * GOLDEN) ^ np.concatenate([kinds[n] for n in marked]).astype(np.int64).view(np.uint64)
        order = np.argsort(known)
        known = known[order]
        a, b = (np.concatenate([column[n] for n in marked]).astype(np.int64)[order] for column in (firsts, lasts))
        found = []
        for number, at, block, ends in cutter.blocks([data[n] for n in marked]):
            part, begin, end, _, _, kind, _ = cutter.stretches(block, ends)
            name = mixed(number[part].astype(np.uint64) * GOLDEN) ^ kind
            slot = np.minimum(np.searchsorted(known, name), len(known) - 1)
            hit = np.flatnonzero(known[slot] == name)
            part, begin, end, slot = part[hit], begin[hit], end[hit], slot[hit]
            base = at[part] - np.concatenate(([0], ends))[part]
            found.append(np.stack([number[part], base + begin + a[slot], base + np.minimum(begin + b[slot], end)], 1))
        parts = np.concatenate(found)
        parts = parts[np.lexsort((parts[:, 1], parts[:, 0]))]
        for n, own in zip(np.unique(parts[:, 0]).tolist(), np.split(parts, np.flatnonzero(np.diff(parts[:, 0])) + 1), strict=True):
            until = np.maximum.accumulate(own[:, 2])
            new = np.append(True, own[1:, 1] > until[:-1])
            start, stop = own[new, 1].tolist(), until[np.append(np.flatnonzero(new)[1:] - 1, len(own) - 1)].tolist()
            text = data[marked[n]]
            kept[marked[n]] = b"".join(text[x:y] for x, y in zip([0, *stop], [*start, len(text)], strict=True))
            spans[marked[n]] = [{"from_byte": x, "to_byte": y} for x, y in zip(start, stop, strict=True)]
    return pd.DataFrame({"kept": kept, "removed": spans})


CUT = "kept binary, removed array<struct<from_byte:int,to_byte:int>>"


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(row, cut): each row of ``docs`` as a struct, and its text's bytes without those that a string of ``length`` bytes
    covers which also starts elsewhere, with the runs removed, as CUT."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = in_small_batches(docs).select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"),
                                          F.xxhash64("text").alias("text_key"), F.col("text"))
    marks = repeated_marks(keyed.select("place", "text_key", "text"), length, gram, hot)
    lists = marks.groupBy(F.col("place").alias("place_"), F.col("text_key").alias("key_")).agg(
        F.collect_set(F.struct("kind", "a", "b")).alias("m"))
    joined = keyed.join(lists, (F.col("place") == F.col("place_")) & (F.col("text_key") == F.col("key_")), "left")
    cutter = Cutter(length, gram)

    @F.pandas_udf(CUT)
    def cut(texts: pd.Series, kinds: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
        return without(cutter, texts, kinds, firsts, lasts)

    return joined.select("row", cut("row.text", "m.kind", "m.a", "m.b").alias("cut"))


def op11_suffixes(spark, sf_dir: str) -> DataFrame:
    done = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("cut.removed", F.lit(0).cast("long"), lambda s, r: s + (r["to_byte"] - r["from_byte"]).cast("long"))
    return done.select(
        "row.doc_id", F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("cut.removed").cast("long").alias("n_spans"), F.sha2("cut.kept", 256).alias("kept_sha256"))
