"""Repeated strings, prefix tries and periodic runs on small fixtures, against brute force."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from conftest import rows  # noqa: E402

from shelfline.llm import periods, suffixes, tries  # noqa: E402

SCHEMA = "doc_id long, text string, place string, row string, kinds string, words string, n string, h string, runs string"


def documents(spark, texts):
    """Rows whose extra columns clash with names that operators use themselves."""
    return spark.createDataFrame([(n, t, *"abcdefg") for n, t in texts], SCHEMA)


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# ------------------------------------------------------------------ repeated strings

def removed(texts, length):
    """Of each text what stays and how many runs go, with every string of ``length`` bytes listed."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((bytes(b for b, g in zip(d, gone, strict=True) if not g), sum(f for _, f in runs_of(gone)), sum(1 for _ in runs_of(gone))))
    return out


def runs_of(flags):
    start = None
    for n, f in enumerate([*flags, 0]):
        if f and start is None:
            start = n
        elif not f and start is not None:
            yield start, n - start
            start = None


def shared_passages(seed):
    draw = random.Random(seed)
    base = ["".join(draw.choice("abcdefgh é") for _ in range(draw.randint(1, 300))) for _ in range(20)]
    texts = [None, "", "a" * 200, "ab" * 90, "x" * 39, "x" * 40, "y" * 40, "y" * 40]
    for _ in range(120):
        text = "".join(draw.choice(base)[draw.randint(0, 50):][:draw.randint(1, 120)] if draw.random() < 0.5 else
                       "".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 60))) for _ in range(draw.randint(1, 4)))
        if text and draw.random() < 0.3:
            at = draw.randrange(len(text))
            text = text[:at] + "Z" + text[at + 1:]
        texts.append(text)
    return texts


@pytest.mark.parametrize("seed, hot", [(1, 4096), (2, 3), (3, 1)])
def test_repeated_strings_agree_with_a_list_of_all(spark, seed, hot):
    texts = shared_passages(seed)
    ids = [*range(len(texts)), 50, None]
    texts += [texts[50], texts[60]]  # a repeated row and a null id
    done = suffixes.cut_repeats(documents(spark, list(zip(ids, texts, strict=True))).repartition(4), 40, 12, hot)
    got = Counter((r.row.doc_id, bytes(r.cut.kept), len(r.cut.removed), sum(s.to_byte - s.from_byte for s in r.cut.removed))
                  for r in done.collect())
    want = Counter((i, kept, n, many) for i, (kept, many, n) in zip(ids, removed(texts, 40), strict=True))
    assert got == want
    assert 0 < sum(m for *_, m in want) < sum(len((t or "").encode()) for t in texts)


def test_long_texts_are_cut_in_blocks(spark, tmp_path):
    draw = random.Random(4)
    passage = "".join(draw.choice("abcdefghijkl ") for _ in range(3000))
    long = "".join(draw.choice("abcdefghijkl ") for _ in range(suffixes.BLOCK - 1000))
    texts = [long + passage + long[:200] + "end", "other " + passage[100:-1], "z" * (2 * suffixes.BLOCK + 5)]
    documents(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in suffixes.op11_suffixes(spark, str(tmp_path)).collect()}
    assert (got[0].n_removed, got[0].n_spans) == (2899, 1)
    assert got[0].kept_sha256 == sha(long + passage[:100] + passage[-1] + long[:200] + "end")
    assert (got[1].n_removed, got[1].kept_sha256) == (2899, sha("other "))
    assert (got[2].n_bytes, got[2].n_removed, got[2].n_spans) == (len(texts[2]), len(texts[2]), 1)


# ------------------------------------------------------------------------------ tries

TURNS = "conv_id long, turn long, role string, text string, ids string, words string, node string"


def conversations(seed):
    draw = random.Random(seed)
    out = []
    for c in [*range(60), 100, 103, 120, -7, 10 ** 12 + 21]:
        for turn in range(draw.randint(0, 6)):
            out.append((c, draw.choice([turn, turn, turn, None]), draw.choice(["user", "bot", None]), draw.choice(["hi", "hi  there\n", "", None, "a b c"])))
    for n in range(40):
        out += [(300 + n, 0, "user", "common first turn"), (300 + n, 1, "bot", f"answer {n % 7}")]
    return [*out, out[0], (None, 0, "user", "nobody"), (500, 0, "user", "x" * 50_000)]


@pytest.mark.parametrize("shard_turns", [3, 40, 200_000])
def test_tries_agree_with_their_sql(spark, tmp_path, shard_turns):
    n = 5
    turns = spark.createDataFrame([(*t, "x", "y", "z") for t in conversations(n)], TURNS).repartition(3)
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM '{tmp_path}/conversations.parquet/*.parquet'")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    want = con.execute(f"SELECT {', '.join(columns)}, ends_sha256 FROM ({tries.OP12_SQL})").fetchall()
    found = tries.prefix_trie(tries.rebuilt(tries.own_sequences(tries.numbered_turns(turns))), shard_turns)
    got = [(*r[:-1], r[-1] or tries.NO_ENDS) for r in rows(found.select(*columns, "ends"))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if shard_turns > 1000:
        assert rows(tries.op12_tries(spark, str(tmp_path)), *columns, "ends_sha256") == sorted(want, key=repr)


def test_search_trees_are_balanced():
    tree = tries.SearchTree()
    for n in tries.medians(1023):
        tree.insert([n, 5], [1, 1], n)
    deepest, level = 0, [tree.first]
    while level:
        deepest += 1
        level = [s for node in level for s in (tree.less[node], tree.more[node]) if s >= 0]
    assert deepest == 10
    assert sorted(tries.medians(100)) == list(range(100))


# ------------------------------------------------------------------------------- runs

def all_runs(words, min_length=6, min_periods=4):
    """Every period's maximal stretches, the smallest period of each stretch."""
    found = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_periods * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def wordy(seed, count):
    draw, out = random.Random(seed), []
    for _ in range(count):
        kinds, n = draw.choice([1, 2, 3, 20]), draw.choice([0, 1, 5, 6, 7, 30, 150])
        words = [f"w{draw.randrange(kinds)}" for _ in range(n)]
        if n > 5 and draw.random() < 0.5:
            a = draw.randrange(n)
            p = 1 + (n - a) // (3 + draw.randrange(8))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        out.append(words)
    return out


@pytest.mark.parametrize("min_length, min_periods", [(6, 4), (2, 2), (9, 3)])
def test_runs_agree_with_all_periods(min_length, min_periods):
    for seed in range(25):
        texts = [[w.encode() for w in t] for t in wordy(seed, 12)]
        got = [tuple(r) for r in periods.find_runs(texts, min_length, min_periods).tolist()]
        want = [(n, *r) for n, t in enumerate(texts) for r in all_runs(t, min_length, min_periods)]
        assert got == sorted(want, key=lambda r: (r[0], r[1], r[3]))


def test_grammar_extends_in_both_directions():
    import numpy as np
    draw = random.Random(8)
    text = [100, *[draw.randrange(2) for _ in range(400)], *[0] * 300, *[0, 1, 1] * 100, 101]
    grammar = periods.Grammar(np.array(text))
    pairs = [tuple(sorted(draw.sample(range(1, len(text) - 1), 2))) for _ in range(500)] + [(401, 402), (701, 704), (500, 600)]
    left, right = (np.array(p) for p in zip(*pairs, strict=True))
    for (a, b), ahead, back in zip(pairs, grammar.common(left, right), grammar.common(left, right, back=True), strict=True):
        assert ahead == next(k for k in range(len(text)) if text[a + k] != text[b + k])
        assert back == next(k for k in range(len(text)) if text[a - k] != text[b - k])


def expected_periods(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        text = b" ".join(words).decode()
    runs = sorted(all_runs(words), key=lambda r: (r[0], r[2]))
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(kept))


def test_period_query_agrees_with_brute_force(spark, tmp_path):
    texts = [" ".join(t) for t in wordy(3, 150)] + [None, "", " \n\t", "a  a a\na a a a a", "ä ö " * 40, "x " * 20_000, "B b " * 10]
    table = [*enumerate(texts), (3, texts[3]), (None, "q q q q q q q"), (None, None)]
    documents(spark, table).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert any(zlib.crc32(str(n).encode()) % 10 == 0 and t for n, t in enumerate(texts))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = rows(periods.op13_periods(spark, str(tmp_path)), *columns)
    assert got == sorted((expected_periods(n, t) for n, t in table), key=repr)


def test_empty_tables_give_empty_results(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    for query in (suffixes.op11_suffixes, tries.op12_tries, periods.op13_periods):
        assert query(spark, str(tmp_path)).collect() == []
