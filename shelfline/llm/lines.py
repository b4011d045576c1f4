"""Line dedup by winnowing over line hashes.

A text is cut into lines after line breaks and, so that passages inside long lines
are seen too, after words that end a sentence. Lines are equal if their words are,
A-Z lower-cased. A window is the shortest stretch of lines from a line on, or up to a
line, that has at least 20 words; a line of 20 words is a window by itself. The line of
least hash in a window, the first of equal ones, is a fingerprint: equal windows
always have the same one, so a window whose fingerprint occurs once is not looked at
again. Around fingerprints that occur again, matches are extended both ways by the
windows that hold them, as far back and ahead as these reach: the positions of equal
windows are joined with their first occurrence, and what matches is their union. So
every run of lines with at least 20 words that occurs earlier, line after line, is
deleted, and nothing else; the first occurrence, in the order of (doc_id, text hash,
place in the text), stays.

Defined cases: null and empty texts have no lines and stay as they are; blank lines
belong to the line before and go with it; repeated rows (same doc_id and text) are
one document and are treated alike; null ids come last; a run that repeats within
its own document is deleted there too; a text with nothing left becomes empty, and
``dedupe`` drops such documents; very long texts are hashed in blocks; extra columns
are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import frees_memory, in_small_batches, table
from shelfline.llm.textbytes import BLOCK_BYTES, GOLDEN, SPACES, WordHasher, mixed
from shelfline.session import materialize

MIN_WORDS = 20
SENTENCE_END = np.array([33, 46, 63], np.uint8)
LAST = (1 << 63) - 1
POSTS = "fingerprint long, place long, text_key long, windows array<struct<hash:long,at:int,until:int>>"


def words_and_breaks(hasher: WordHasher, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, whether a line starts here) of each word of a text or of joined texts, block by block."""
    hashes, starts, breaks = [], [], []
    begin, pending = 0, True
    while begin < len(data):
        stop = SPACES.search(data, min(begin + BLOCK_BYTES, len(data)))
        end = stop.start() if stop else len(data)
        block = np.frombuffer(data, np.uint8, end - begin, begin)
        found, start, until = hasher.words(block)
        newlines = np.concatenate(([0], np.cumsum(block == 10)))
        if len(found):
            since = np.concatenate(([0], until[:-1]))
            fresh = newlines[start] > newlines[since]
            fresh[1:] |= np.isin(block[until[:-1] - 1], SENTENCE_END)
            fresh[0] |= pending
            hashes.append(found)
            starts.append(start + begin)
            breaks.append(fresh)
            pending = bool(newlines[-1] > newlines[until[-1]]) or bool(block[until[-1] - 1] in SENTENCE_END)
        else:
            pending |= bool(newlines[-1])
        begin = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, bool)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(breaks)


def lines_of(hasher: WordHasher, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, start, end) of each line; a line ends where the next one or nothing follows."""
    return sized_lines(hasher, texts)[:4]


def sized_lines(hasher: WordHasher, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same and the number of words of each line."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts, breaks = words_and_breaks(hasher, b"\n".join(texts))
    if not len(hashes):
        return (np.zeros(0, int),) * 5
    owner = np.searchsorted(ends, starts, side="right")
    breaks[1:] |= owner[1:] != owner[:-1]
    first = np.flatnonzero(breaks)
    sizes = np.diff(np.append(first, len(hashes)))
    number = np.arange(len(hashes)) - np.repeat(first, sizes)
    line = np.add.reduceat(mixed(hashes + number.astype(np.uint64) * GOLDEN), first)
    owner, begin = owner[first], starts[first]
    until = np.append(begin[1:], 0)
    last = np.append(owner[1:] != owner[:-1], True)
    until[last] = ends[owner[last]] - 1
    base = (ends - [len(t) + 1 for t in texts])[owner]
    return owner, line.view(np.int64), begin - base, until - base, sizes


def windows(owner: np.ndarray, sizes: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) line of the shortest stretches of ``least`` words from each line on and up to each line of a text."""
    words = np.concatenate(([0], np.cumsum(sizes)))
    line = np.arange(len(sizes))
    last = np.searchsorted(words, words[:-1] + least) - 1
    ahead = np.flatnonzero(last < len(sizes))
    ahead = ahead[owner[last[ahead]] == owner[ahead]]
    first = np.searchsorted(words, words[1:] - least, side="right") - 1
    back = np.flatnonzero(first >= 0)
    back = back[owner[first[back]] == owner[back]]
    pairs = np.unique(np.concatenate((line[ahead] * (len(sizes) + 1) + last[ahead], first[back] * (len(sizes) + 1) + line[back])))
    return pairs // (len(sizes) + 1), pairs % (len(sizes) + 1)


def fingerprints(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Of each window the position of its least hash, the first of equal ones."""
    best = first.copy()
    for k in range(1, int((last - first).max(initial=0)) + 1):
        more = np.flatnonzero(first + k <= last)
        other = first[more] + k
        better = hashes[other] < hashes[best[more]]
        best[more[better]] = other[better]
    return best


def window_hashes(line: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the lines of each window, wherever it lies."""
    odd = int(GOLDEN) | 1
    powers = np.cumprod(np.full(len(line), odd, np.uint64))
    back = np.cumprod(np.full(len(line), pow(odd, -1, 1 << 64), np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(line.view(np.uint64) + GOLDEN) * powers)))
    return mixed((sums[last + 1] - sums[first]) * back[first] ^ (last - first + 1).astype(np.uint64) * GOLDEN).view(np.int64)


def in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(texts, places, text keys) of bounded size together, from (place, text_key, text)."""
    for batch in batches:
        places, keys = batch.column("place").to_numpy(), batch.column("text_key").to_numpy()
        group: list[bytes] = []
        first = size = 0
        for n, value in enumerate(batch.column("text")):
            text = value.as_buffer().to_pybytes() if value.is_valid else b""
            if group and size + len(text) > BLOCK_BYTES:
                yield group, places[first:n], keys[first:n]
                group, first, size = [], n, 0
            group.append(text)
            size += len(text)
        if group:
            yield group, places[first:], keys[first:]


def post_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, text_key, text) to the hashes of fingerprints."""
    hasher = WordHasher()
    for texts, _, _ in in_groups(batches):
        owner, line, _, _, sizes = sized_lines(hasher, texts)
        picked = np.unique(fingerprints(line, *windows(owner, sizes)))
        yield pa.RecordBatch.from_arrays([pa.array(line[picked], pa.int64())], names=["fingerprint"])


def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, text_key, text) to a row per fingerprint with the windows that it is the least of."""
    hasher = WordHasher()
    for texts, places, keys in in_groups(batches):
        owner, line, at, until, sizes = sized_lines(hasher, texts)
        first, last = windows(owner, sizes)
        best = fingerprints(line, first, last)
        order = np.argsort(best, kind="stable")
        first, last = first[order], last[order]
        picked, begin = np.unique(best[order], return_index=True)
        held = pa.StructArray.from_arrays(
            [pa.array(window_hashes(line, first, last), pa.int64()), pa.array(at[first], pa.int32()), pa.array(until[last], pa.int32())],
            ["hash", "at", "until"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(order)), pa.int32()), held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(line[picked], pa.int64()), pa.array(places[owner[picked]], pa.int64()),
             pa.array(keys[owner[picked]], pa.int64()), lists], names=["fingerprint", "place", "text_key", "windows"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(place_, key_, spans): byte ranges of each document whose lines occur earlier.

    Only the hashes of fingerprints are counted over all documents; the windows of
    those that repeat are written once. Every later window is joined with one row, its
    first occurrence.
    """
    texts = docs.select("place", "text_key", "text")
    # Written, so that the join below is one of two plain shuffles, whose hot lines Spark can split.
    repeated = materialize(texts.mapInArrow(frees_memory(post_fingerprints), "fingerprint long").groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint"), "repeated-fingerprints")
    around = materialize(texts.mapInArrow(frees_memory(post), POSTS).join(repeated, "fingerprint").select(
        "place", "text_key", F.explode("windows").alias("w")).select("place", "text_key", "w.*"), "windows")
    source = materialize(around.groupBy("hash").agg(
        F.min(F.struct("place", "text_key", "at")).alias("s"), F.count(F.lit(1)).alias("n")).where("n > 1").select("hash", "s"), "first-places")
    matched = around.join(source, "hash").where("place <> s.place OR text_key <> s.text_key OR at <> s.at")
    return matched.groupBy(F.col("place").alias("place_"), F.col("text_key").alias("key_")).agg(
        F.collect_set(F.struct(F.col("at").alias("a"), F.col("until").alias("b"))).alias("spans"))


def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """Each text without its repeated runs, and the byte ranges deleted."""
    out = []
    for text, found in zip(texts, spans, strict=True):
        if text is None or found is None or not len(found):
            out.append((text, []))
            continue
        data, pieces, done, deleted = text.encode(), [], 0, []
        runs: list[list[int]] = []
        for span in sorted(found, key=lambda s: s["a"]):
            if runs and span["a"] <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], span["b"])
            else:
                runs.append([span["a"], span["b"]])
        for a, b in runs:
            pieces.append(data[done:a])
            done = b
            deleted.append({"from_byte": a, "to_byte": b})
        out.append(((b"".join(pieces) + data[done:]).decode(), deleted))
    return pd.DataFrame(out, columns=["text", "deleted"])


CUT = "text string, deleted array<struct<from_byte:int,to_byte:int>>"


def dedupe_lines(docs: DataFrame) -> DataFrame:
    """(row, cut): each row of ``docs`` as a struct, and its text without later repeated runs, as CUT."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = in_small_batches(docs).select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"),
                        F.xxhash64("text").alias("text_key"), F.col("text"))
    marked = keyed.join(repeated_spans(keyed), (F.col("place") == F.col("place_")) & (F.col("text_key") == F.col("key_")), "left")
    return marked.select("row", F.pandas_udf(cut, CUT)("row.text", "spans").alias("cut"))


def dedupe(docs: DataFrame) -> DataFrame:
    """The documents without later repeated runs; those with nothing left go. Same columns; n_chars follows the text."""
    done = dedupe_lines(docs).where(
        F.col("cut.text").isNull() | (F.size("cut.deleted") == 0) | (F.trim("cut.text") != ""))
    new = {"text": F.col("cut.text"), "n_chars": F.when(F.size("cut.deleted") > 0, F.length("cut.text")).otherwise(
        F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return done.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op3_lines(spark, sf_dir: str) -> DataFrame:
    return dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", F.size("cut.deleted").alias("n_runs"), "cut.deleted",
        F.length("cut.text").cast("long").alias("n_chars_left"), F.sha2(F.col("cut.text").cast("binary"), 256).alias("left_sha256"))
