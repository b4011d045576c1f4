"""SentencePiece encoding and decoding with seeded merge-dropout.

Text becomes pieces of a byte-pair vocabulary: symbols start as characters, and the
neighbours whose joint piece has the best score merge first, the leftmost of equal
ones. A keyed hash of the seed, the document, its copy number, the number of the word
in it and the place of a candidate merge decides whether it is skipped, so that every
occurrence of a word has draws of its own, fixed by the seed. Without dropout the pieces are those that the public
SentencePiece library gives. Every text decodes exactly: characters outside the vocabulary, and the
mark that stands for a space, are spelled in bytes.

Words never share a merge. Each distinct word of a stretch of text is first worked out
without dropout, with a note of every candidate merge that the agenda looks at. Draws
are made for these, for each occurrence: where none is skipped, the plain pieces are
the occurrence's own, and only the others are worked out one by one, drawing as the
agenda goes. Many words are worked at a time, as rows of a matrix of symbols; very long
words use an agenda of their own.

Defined cases: null gives null ids, an empty text none; texts of any length are
encoded whole, in stretches; repeated rows (same id and text) are numbered as copies
and drawn for each; a null id has its own draws, by the text; extra columns do no harm; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import frees_memory, in_small_batches, small_side, table
from shelfline.llm.textbytes import GOLDEN, mixed
from shelfline.session import materialize

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 7
STRETCH = 1_500_000
DRAWN = 50_000
COPIES = 1_000
LONG_WORD = 48
SLOTS = 18
SPACE = "▁"
WORD = re.compile(r" +[^ ]*")
NEVER = np.iinfo(np.int32).max
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
Note = Callable[[np.ndarray, np.ndarray, np.ndarray], None]


@dataclass
class Vocabulary:
    """Pieces as bytes, byte pieces, characters, and the merges of pairs in a hash table."""

    piece_bytes: np.ndarray   # all pieces' bytes one after another, spaces as spaces
    piece_starts: np.ndarray
    byte_ids: np.ndarray      # 256: the piece of each byte
    chars: np.ndarray         # code point to piece, or size + code point where there is none
    keys: np.ndarray          # 2 ** SLOTS: left * 2 ** 21 + right of a pair, or -1
    merged: np.ndarray        # the pair's piece
    rank: np.ndarray          # per piece: its place in the order of merges

    @property
    def size(self) -> int:
        return len(self.piece_starts) - 1

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that each pair merges into, or -1."""
        key = left.astype(np.int64) << 21 | right.astype(np.int64)
        slot = slot_of(key)
        found = np.full(len(key), -1, np.int32)
        open_ = np.arange(len(key))
        while len(open_):
            at = self.keys[slot[open_]]
            hit = at == key[open_]
            found[open_[hit]] = self.merged[slot[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
            slot[open_] = (slot[open_] + 1) & ((1 << SLOTS) - 1)
        return found


def slot_of(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * GOLDEN) >> np.uint64(64 - SLOTS)).astype(np.int64)


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a byte-pair model file with the public library, on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(n) for n in range(size)]
    plain = {p: n for n, p in enumerate(pieces)
             if not (model.is_byte(n) or model.is_control(n) or model.is_unknown(n) or model.is_unused(n))}
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    raw = [b""] * size
    for piece, n in plain.items():
        raw[n] = piece.replace(SPACE, " ").encode()
    for b, n in enumerate(byte_ids.tolist()):
        raw[n] = bytes([b])
    chars = np.arange(0x110000, dtype=np.int32) + size
    for piece, n in plain.items():
        if len(piece) == 1:
            chars[ord(piece)] = n
    chars[ord(" ")], chars[ord(SPACE)] = plain[SPACE], size + ord(SPACE)
    pairs = {(plain[p[:k]] << 21 | plain[p[k:]]): n for p, n in plain.items() for k in range(1, len(p))
             if p[:k] in plain and p[k:] in plain}
    scores = np.array([model.get_score(n) for n in range(size)])
    rank = np.empty(size, np.int32)
    rank[np.argsort(-scores, kind="stable")] = np.arange(size)
    keys, merged = np.full(1 << SLOTS, -1, np.int64), np.zeros(1 << SLOTS, np.int32)
    rest, into = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
    slot = slot_of(rest)
    while len(rest):
        free = np.flatnonzero(keys[slot] < 0)
        _, first = np.unique(slot[free], return_index=True)
        taken = free[first]
        keys[slot[taken]], merged[slot[taken]] = rest[taken], into[taken]
        left = np.ones(len(rest), bool)
        left[taken] = False
        rest, into, slot = rest[left], into[left], (slot[left] + (keys[slot[left]] != rest[left])) & ((1 << SLOTS) - 1)
    return Vocabulary(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), byte_ids, chars, keys, merged, rank)


class Encoder:
    def __init__(self, words: Vocabulary, dropout: float = DROPOUT, seed: int = SEED) -> None:
        self.words, self.seed = words, np.uint64(seed)
        self.skip_below = np.uint64(min(int(dropout * 2 ** 64), 2 ** 64 - 1))

    def skipped(self, row_key: np.ndarray, start: np.ndarray, into: np.ndarray) -> np.ndarray:
        """Whether the merge into a piece at a place of a word is skipped."""
        draw = mixed(row_key + start.astype(np.uint64) * GOLDEN + into.astype(np.uint64) * OTHER)
        return draw < self.skip_below

    def ranks(self, left: np.ndarray, right: np.ndarray, row_key: np.ndarray | None, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair, its place in the order of merges (NEVER if there is none or it is skipped) and its piece; nothing is
        skipped without a key."""
        into = self.words.look_up(left, right)
        rank = np.where(into >= 0, self.words.rank[np.maximum(into, 0)], NEVER)
        if self.skip_below and row_key is not None:
            some = np.flatnonzero(into >= 0)
            rank[some[self.skipped(row_key[some], start[some], into[some])]] = NEVER
        return rank, into

    def merge_rows(self, symbols: np.ndarray, row_key: np.ndarray | None, note: Note | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Merge the words in the rows of a matrix; (matrix, which of its symbols are left).

        A merged piece stays at the place of its left part, and pointers lead from
        place to place, so that a merge touches its neighbours only. ``note`` is
        called with (row, start, piece) of the candidates looked at.
        """
        count, width = symbols.shape
        left = np.ones(symbols.shape, bool)
        if width < 2:
            return symbols, left
        symbols = symbols.copy().ravel()
        place = np.arange(width, dtype=np.int32)
        after, before = np.tile(place + 1, count), np.tile(place - 1, count)
        rank = np.full((count, width), NEVER, np.int32)
        into = np.full(count * width, -1, np.int32)
        cell = (np.arange(count)[:, None] * width + np.arange(width - 1)).ravel()
        keys = np.repeat(row_key, width - 1) if row_key is not None else None
        flat, alive = rank.ravel(), left.ravel()
        flat[cell], into[cell] = self.ranks(symbols[cell], symbols[cell + 1], keys, cell % width)
        if note:
            some = cell[into[cell] >= 0]
            note(some // width, some % width, into[some])
        active = np.arange(count)
        while len(active):
            at = rank[active].argmin(axis=1)
            base = active * width
            going = flat[base + at] < NEVER
            active, at, base = active[going], at[going], base[going]
            if not len(active):
                break
            here = base + at
            gone = base + after[here]
            symbols[here] = into[here]
            alive[gone] = False
            flat[gone] = NEVER
            then = after[gone]
            after[here] = then
            inner = then < width
            before[(base + then)[inner]] = at[inner]
            flat[here[~inner]] = NEVER
            outer = before[here] >= 0
            # The pairs on both sides of the new piece.
            first = np.concatenate(((base + before[here])[outer], here[inner]))
            second = np.concatenate((here[outer], (base + then)[inner]))
            row, start = first // width, first % width
            flat[first], into[first] = _, made = self.ranks(
                symbols[first], symbols[second], row_key[row] if row_key is not None else None, start)
            if note:
                some = made >= 0
                note(row[some], start[some], made[some])
        return symbols.reshape(count, width), left

    def merge_long(self, symbols: np.ndarray, row_key: np.uint64) -> np.ndarray:
        """The same for one very long word, by an agenda of candidate merges."""
        n = len(symbols)
        keys = np.full(n, row_key)
        rank, into = self.ranks(symbols[:-1], symbols[1:], keys[:-1], np.arange(n - 1))
        ids = symbols.tolist()
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        agenda = [(r, k, k + 1, p, ids[k], ids[k + 1]) for k, (r, p) in enumerate(zip(rank.tolist(), into.tolist(), strict=True)) if r < NEVER]
        heapq.heapify(agenda)
        while agenda:
            _, a, b, piece, left, right = heapq.heappop(agenda)
            if not (alive[a] and b < n and alive[b] and after[a] == b and ids[a] == left and ids[b] == right):
                continue
            ids[a], alive[b], after[a] = piece, False, after[b]
            if after[a] < n:
                before[after[a]] = a
            for x, y in ((before[a], a), (a, after[a])):
                if x >= 0 and y < n:
                    r, p = self.ranks(np.array([ids[x]]), np.array([ids[y]]), keys[:1], np.array([x]))
                    if r[0] < NEVER:
                        heapq.heappush(agenda, (int(r[0]), x, y, int(p[0]), ids[x], ids[y]))
        return np.array([s for s, a in zip(ids, alive, strict=True) if a], np.int32)

    def plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(all ids, where each word's start, with the end) of words without dropout, and (start, piece, where each word's
        begin, with the end) of the candidates looked at. A very long word has none of either."""
        noted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int32))]
        ids, starts = self.encode_words(words, None, lambda *found: noted.append(found))
        word, start, into = (np.concatenate(c) for c in zip(*noted, strict=True))
        order = np.argsort(word, kind="stable")
        return ids, starts, start[order], into[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def deviating(self, code: np.ndarray, row_key: np.ndarray, start: np.ndarray, into: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Occurrences of words for which a candidate that the plain agenda looks at is skipped."""
        found = []
        for n in range(0, len(code), DRAWN):
            part = code[n:n + DRAWN]
            many = first[part + 1] - first[part]
            ends = np.cumsum(many)
            at = np.arange(ends[-1]) + np.repeat(first[part] - (ends - many), many)
            skipped = np.flatnonzero(self.skipped(np.repeat(row_key[n:n + DRAWN], many), start[at], into[at]))
            found.append(n + np.unique(np.searchsorted(ends, skipped, side="right")))
        return np.concatenate(found)

    def encode_words(self, words: list[str], keys: np.ndarray | None, note: Note | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, where each word's ids start, with the end) of words and the keys of their draws.

        Without keys nothing is skipped and very long words are left out; ``note`` gets the candidates looked at.
        """
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) for w in words])
        begin = np.concatenate(([0], np.cumsum(sizes)))
        symbols = self.words.chars[code]
        many = np.zeros(len(words), int)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            if size > LONG_WORD:
                for r in rows.tolist() if keys is not None else []:
                    ids = self.merge_long(symbols[begin[r]:begin[r + 1]], keys[r])
                    many[r] = len(ids)
                    parts.append((np.array([r]), ids[None, :], np.ones((1, len(ids)), bool)))
                continue
            noted = (lambda row, start, into, rows=rows: note(rows[row], start, into)) if note else None
            found, left = self.merge_rows(
                symbols[begin[rows][:, None] + np.arange(size)], keys[rows] if keys is not None else None, noted)
            many[rows] = left.sum(axis=1)
            parts.append((rows, found, left))
        starts = np.concatenate(([0], np.cumsum(many)))
        flat = np.empty(starts[-1], np.int32)
        for rows, found, left in parts:
            flat[(starts[rows][:, None] + np.cumsum(left, axis=1) - 1)[left]] = found[left]
        return self.spelled(flat, starts)

    def spelled(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary become the pieces of their bytes."""
        unknown = np.flatnonzero(flat >= self.words.size)
        if not len(unknown):
            return flat, starts
        point = flat[unknown] - self.words.size
        wide = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        widths = np.ones(len(flat), int)
        widths[unknown] = wide
        places = np.concatenate(([0], np.cumsum(widths)))
        out = np.repeat(flat, widths)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for k in range(4):
            some = wide > k
            shift = 6 * (wide[some] - 1 - k)
            value = (point[some] >> shift) & np.where((k == 0) & (wide[some] == 1), 0x7F, 0x3F)
            value = value | (lead[wide[some]] if k == 0 else 0x80)
            out[places[unknown[some]] + k] = self.words.byte_ids[value]
        return out, places[starts]

    def encode(self, texts: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's start, with the end) of (key, text)s of bounded size together."""
        words: list[str] = []
        counts = []
        for _, text in texts:
            found = WORD.findall(text)
            words += found
            counts.append(len(found))
        ends = np.concatenate(([0], np.cumsum(counts))).astype(int)
        if not words:
            return np.zeros(0, np.int32), ends
        code, distinct = pd.factorize(np.array(words, dtype=object))
        keys = np.repeat(np.array([k for k, _ in texts], np.int64).astype(np.uint64), counts)
        number = (np.arange(len(words)) - np.repeat(ends[:-1], counts)).astype(np.uint64)
        row_key = mixed(mixed(keys * GOLDEN + self.seed) + number * OTHER)
        words_of = distinct.tolist()
        ids, starts, *looked_at = self.plain(words_of)
        begin, sizes = starts[code], np.diff(starts)[code]
        own = np.array([len(w) > LONG_WORD for w in words_of])[code]
        if self.skip_below:
            own[self.deviating(code, row_key, *looked_at)] = True
        rest = np.flatnonzero(own)
        if len(rest):
            more, at = self.encode_words([words_of[c] for c in code[rest].tolist()], row_key[rest])
            begin[rest], sizes[rest] = len(ids) + at[:-1], np.diff(at)
            ids = np.concatenate((ids, more))
        places = np.concatenate(([0], np.cumsum(sizes)))
        out = ids[np.repeat(begin - places[:-1], sizes) + np.arange(places[-1])]
        return out, places[ends]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes that ids spell, with the leading space that encoding puts first."""
        begin, sizes = self.words.piece_starts[ids], np.diff(self.words.piece_starts)[ids]
        places = np.concatenate(([0], np.cumsum(sizes)))
        return self.words.piece_bytes[np.repeat(begin - places[:-1], sizes) + np.arange(places[-1])].tobytes()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids, np.int64))[1:].decode()

    def encode_text(self, text: str, key: int = 0) -> np.ndarray:
        found = [self.encode([(key + n, part)])[0] for n, part in enumerate(stretches(text))]
        return np.concatenate(found) if found else np.zeros(0, np.int32)

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, draw, text) to doc_id, ids and whether they decode to the text; ``draw`` keys the draws."""
        for batch in batches:
            ids, draws = batch.column("doc_id").to_pylist(), batch.column("draw").to_pylist()
            group: list[tuple[int, int, str]] = []
            size = 0
            for n, value in enumerate(batch.column("text")):
                text = value.as_py()
                if size + len(text or "") > STRETCH and group:
                    yield self.rows(ids, group)
                    group, size = [], 0
                group.append((n, draws[n] & ((1 << 62) - 1), text))
                size += len(text or "")
            if group:
                yield self.rows(ids, group)

    def rows(self, ids: list, group: list[tuple[int, int, str | None]]) -> pa.RecordBatch:
        parts = [(k, key + m, part) for k, (_, key, text) in enumerate(group) for m, part in enumerate(stretches(text or ""))]
        if len(group) == 1:
            flat = np.concatenate([self.encode([(key, part)])[0] for _, key, part in parts] or [np.zeros(0, np.int32)])
            ends = np.array([0, len(flat)])
        else:
            flat, starts = self.encode([(key, part) for _, key, part in parts])
            ends = np.concatenate(([0], starts[np.searchsorted([k for k, _, _ in parts], np.arange(len(group)), side="right")]))
        lossless = []
        for k, (_, _, text) in enumerate(group):
            spelled = self.decode_bytes(flat[ends[k]:ends[k + 1]])
            lossless.append(spelled == b" " + text.encode() if text else not spelled)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()),
                                         mask=pa.array([text is None for _, _, text in group]))
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[n] for n, _, _ in group], pa.int64()), lists, pa.array(lossless)], names=["doc_id", "ids", "lossless"])


def stretches(text: str) -> Iterator[str]:
    """A text with a space put first, in pieces of bounded size that begin with a space and end before one."""
    if not text:
        return
    text = " " + text
    start = 0
    while start < len(text):
        end = start + STRETCH
        while end < len(text):
            end = text.find(" ", end)
            if end < 0:
                end = len(text)
            elif text[end - 1] == " ":
                end += 1
                continue
            break
        yield text[start:end]
        start = end


def numbered_copies(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_key and the number of the copy of each row among those of the same id and text.

    Rows are counted by id and a hash of the text; those that are alone stay where they
    are. Of the others one text per id travels, and is then repeated in blocks of copies.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    counts = materialize(keyed.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"), "n"), "repeated-rows")
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_"))
    if counts.isEmpty():
        return keyed.withColumn("copy", F.lit(1))
    repeated = small_side(counts)
    alone = keyed.join(repeated, same, "left_anti").withColumn("copy", F.lit(1))
    texts = keyed.join(repeated, same).groupBy("doc_id", "text_key").agg(F.first("text").alias("text"), F.first("n").alias("n"))
    blocks = texts.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})"))).repartition("doc_id", "text_key", "block")
    copies = F.expr(f"transform(sequence(block * {COPIES} + 1, least(n, (block + 1) * {COPIES})), k -> int(k))")
    return alone.unionByName(blocks.withColumn("copy", F.explode(copies)).select("doc_id", "text", "text_key", "copy"))


def encode_documents(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, ids and lossless per document. The vocabulary is read once and travels with the job."""
    encoder = Encoder(load_vocabulary(model), dropout, seed)
    draw = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_key")), "copy")
    return in_small_batches(numbered_copies(docs).select("doc_id", draw.alias("draw"), "text")).mapInArrow(
        frees_memory(encoder.batches), "doc_id long, ids array<int>, lossless boolean")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows of (doc_id, ids)."""
    encoder = Encoder(load_vocabulary(model), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if v is None else encoder.decode(v) for v in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op7_pieces(spark, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"), "ids", "lossless")
