"""Periodic runs of words, found by recompression.

The words of some texts, one text after another with a symbol of its own between, are
compressed alternately: blocks of equal symbols become one symbol each, then pairs of
a symbol of one half of the alphabet and one of the other become one symbol each, until
little is left. Every step depends on neighbours only, so equal stretches are cut alike
but for their ends; the levels are a run-length grammar of all words. How far two
places agree, forwards or backwards, is read off the grammar by climbing while both
symbols begin a larger one, stepping over equal symbols or blocks, and going down where
they differ. All such questions of a level of work are answered together with numpy.

A run of period q and of at least four periods holds a multiple of 3q whose word equals
the one q further on. These places, a harmonic grid over all periods, are the
candidates; the grammar extends each exactly in both directions. The same stretch is
also found under multiples of its period, of which the smallest is kept.

Defined cases: null and empty texts have no words and no runs; texts of any length are
taken whole, a text beyond the block size by itself; equal texts and repeated rows
give equal results; a null id is kept and its text not rewritten by the query; extra
columns do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import in_small_batches, table
from shelfline.llm.textbytes import GOLDEN, mixed

MIN_LENGTH = 6
MIN_PERIODS = 4
BLOCK_WORDS = 300_000
QUESTIONS = 400_000
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


@dataclass
class Level:
    """Symbols of one level and how they make up the next one."""

    symbols: np.ndarray
    above: np.ndarray   # the symbol of the next level that this one is part of
    begins: np.ndarray  # whether it is that symbol's first part
    ends: np.ndarray    # whether it is its last part
    after: np.ndarray   # how many equal symbols of a block follow from here, itself included
    before: np.ndarray  # the same looking back
    first: np.ndarray   # of each symbol of the next level, its first part
    last: np.ndarray    # and its last part


def next_level(symbols: np.ndarray, starts: np.ndarray, after: np.ndarray, before: np.ndarray, above: np.ndarray) -> Level:
    begins = np.zeros(len(symbols), bool)
    begins[starts] = True
    return Level(symbols, above, begins, np.append(begins[1:], True), after, before, starts, np.append(starts[1:], len(symbols)) - 1)


def compress_blocks(symbols: np.ndarray, fresh: int) -> tuple[Level, np.ndarray, int]:
    """(level, symbols of the next one, next unused symbol): blocks of equal symbols become one."""
    starts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    sizes = np.diff(np.append(starts, len(symbols)))
    above = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(len(symbols)) - starts[above]
    out = symbols[starts].copy()
    large = np.flatnonzero(sizes > 1)
    if len(large):
        kinds, name = np.unique(out[large] << 31 | sizes[large], return_inverse=True)
        out[large] = fresh + name
        fresh += len(kinds)
    return next_level(symbols, starts, sizes[above] - place, place + 1, above), out, fresh


def compress_pairs(symbols: np.ndarray, fresh: int, salt: int) -> tuple[Level, np.ndarray, int]:
    """The same for pairs of a left and a right symbol; a hash of the symbol and the level picks its half."""
    right = mixed(symbols.astype(np.uint64) * GOLDEN + np.uint64(salt)) >> np.uint64(63) == 1
    pair = np.flatnonzero(~right[:-1] & right[1:])
    begins = np.ones(len(symbols), bool)
    begins[pair + 1] = False
    starts = np.flatnonzero(begins)
    above = np.cumsum(begins) - 1
    out = symbols[starts].copy()
    if len(pair):
        kinds, name = np.unique(symbols[pair] << 31 | symbols[pair + 1], return_inverse=True)
        out[above[pair]] = fresh + name
        fresh += len(kinds)
    single = np.ones(len(symbols), np.int64)
    return next_level(symbols, starts, single, single, above), out, fresh


class Grammar:
    """Levels of a sequence of numbers whose first and last occur nowhere else."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.levels: list[Level] = []
        fresh = int(symbols.max()) + 1
        while len(symbols) > 2 and len(self.levels) < 120:
            step = compress_pairs(symbols, fresh, len(self.levels)) if len(self.levels) % 2 else compress_blocks(symbols, fresh)
            self.levels.append(step[0])
            symbols, fresh = step[1], step[2]
        end = np.zeros(len(symbols), bool)
        one = np.ones(len(symbols), np.int64)
        self.levels.append(Level(symbols, one, end, end, one, one, one, one))

    def common(self, left: np.ndarray, right: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols agree from each two places (left < right) on, or looking back from them."""
        out = np.zeros(len(left), np.int64)
        a, b = left.astype(np.int64), right.astype(np.int64)
        query = np.arange(len(left))
        # Up: all questions of a level stay there until they climb or find a difference.
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for k, level in enumerate(self.levels):
            edge, many, sign = (level.ends, level.before, -1) if back else (level.begins, level.after, 1)
            up: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            while len(query):
                same = level.symbols[a] == level.symbols[b]
                if not same.all():
                    waiting.setdefault(k, []).append((query[~same], a[~same], b[~same]))
                    query, a, b = query[same], a[same], b[same]
                climb = edge[a] & edge[b]
                if climb.any():
                    up.append((query[climb], level.above[a[climb]], level.above[b[climb]]))
                    query, a, b = query[~climb], a[~climb], b[~climb]
                step = sign * np.minimum(many[a], many[b])
                a, b = a + step, b + step
            if not up:
                break
            query, a, b = (np.concatenate(c) for c in zip(*up, strict=True))
        # Down: a difference of a level is one among the parts of the two symbols.
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(max(waiting, default=-1), -1, -1):
            level = self.levels[k]
            many, sign = (level.before, -1) if back else (level.after, 1)
            held = held + waiting.get(k, [])
            query, a, b = (np.concatenate(c) for c in zip(*held, strict=True))
            open_ = np.flatnonzero(level.symbols[a] == level.symbols[b])
            while len(open_):
                step = sign * np.minimum(many[a[open_]], many[b[open_]])
                a[open_] += step
                b[open_] += step
                open_ = open_[level.symbols[a[open_]] == level.symbols[b[open_]]]
            if k == 0:
                out[query] = np.abs(a - left[query])
                break
            part = self.levels[k - 1].last if back else self.levels[k - 1].first
            held = [(query, part[a], part[b])]
        return out


def grid(sizes: np.ndarray, min_periods: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the candidates of texts of so many words, in bounded portions."""
    longest = np.maximum(sizes // min_periods, 0)
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    step = (min_periods - 1) * period
    counts = (sizes[text] - period - 1) // step + 1
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(text):
        stop = max(int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + QUESTIONS, side="right")), begin + 1)
        some = np.arange(begin, stop)
        many = counts[some]
        which = np.repeat(some, many)
        number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        yield text[which], number * step[which], period[which]
        begin = stop


def find_runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows (text, start, length, period) of the maximal runs of the texts' words, in this order."""
    sizes = np.array([len(t) for t in texts], np.int64)
    code = pd.factorize(np.array([w for t in texts for w in t], dtype=object))[0].astype(np.int64)
    # Each text's words come after a symbol that occurs nowhere else; so does the end.
    begin = np.cumsum(sizes + 1) - sizes
    symbols = np.empty(len(code) + len(texts) + 1, np.int64)
    own = np.ones(len(symbols), bool)
    own[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(code))] = False
    symbols[~own] = code
    symbols[own] = len(code) + np.arange(len(texts) + 1)
    found = []
    grammar = None
    for text, place, period in grid(sizes, min_periods):
        at = begin[text] + place
        some = np.flatnonzero(symbols[at] == symbols[at + period])
        if not len(some):
            continue
        text, period, at = text[some], period[some], at[some]
        grammar = grammar or Grammar(symbols)
        more = grammar.common(at, at + period)
        less = grammar.common(at - 1, at + period - 1, back=True)
        start, length = at - less - begin[text], less + period + more
        long = length >= np.maximum(min_length, min_periods * period)
        found.append(np.unique(np.stack([text, start, length, period], 1)[long], axis=0))
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    # Sorted by text, start, length and period: the first of a stretch has its smallest period.
    smallest = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))[:len(rows)]
    rows = rows[smallest]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapse(texts: list[list[bytes]], runs: np.ndarray) -> list[list[bytes]]:
    """Each text's words without those that a run holds after its first period."""
    out = list(texts)
    first = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    for n in np.unique(runs[:, 0]).tolist():
        covered = np.zeros(len(texts[n]) + 1, np.int64)
        own = runs[first[n]:first[n + 1]]
        np.add.at(covered, own[:, 1] + own[:, 3], 1)
        np.add.at(covered, own[:, 1] + own[:, 2], -1)
        out[n] = list(compress(texts[n], (np.cumsum(covered[:-1]) == 0).tolist()))
    return out


def answers(min_length: int, min_periods: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to the rows of FOUND, for some texts at a time."""
    def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = find_runs(texts, min_length, min_periods)
        kept = [b" ".join(t).decode() for t in collapse(texts, runs)]
        parts = pa.StructArray.from_arrays([pa.array(runs[:, c], pa.int64()) for c in (1, 2, 3)], ["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(runs[:, 0], np.arange(len(texts) + 1)), pa.int32()), parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), lists, pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            # Bytes split at exactly the six ASCII white-space characters.
            words = value.as_buffer().to_pybytes().split() if value.is_valid else []
            if texts and size + len(words) > BLOCK_WORDS:
                yield done(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(words)
            size += len(words)
        if texts:
            yield done(ids, texts)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """doc_id, n_words, the runs of words by start and period, and the text with each run cut to its first period.

    Rows stay where they are: no shuffle. Runs are reported from ``min_periods`` periods (at least 2) and ``min_length`` words on.
    """
    if min_periods < 2:
        raise ValueError("a run has at least two periods")
    return in_small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(
        lambda batches: answers(min_length, min_periods, batches), FOUND)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), 1)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts repeat a stretch of words from some place on, as their ids' checksums say."""
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = F.col("h") % 10 == 0
    found = hashed.withColumn("words", F.when(chosen, words_of(F.col("text")))).withColumn("n", F.size("words"))
    found = found.withColumn("g", F.floor(F.col("h") / 10).cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = found.withColumn("p", F.expr("1L + (n - a) div (3 + g % 8)"))
    text = F.expr("concat_ws(' ', transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p AS int)])))")
    return planted.select("doc_id", F.when(F.coalesce(F.col("n") > 0, F.lit(False)), text).otherwise(F.col("text")).alias("text"))


def op13_periods(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = periodic_runs(with_planted_runs(docs))
    # Runs come by start, then period: the first of the greatest length per period is the one wanted.
    best = F.expr(
        "aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), "
        "(best, r) -> if(best IS NULL OR r.length * best.period > best.length * r.period, r, best))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
