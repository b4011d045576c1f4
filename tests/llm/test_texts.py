"""Text operators on small fixtures, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import sys
from pathlib import Path

import duckdb
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from conftest import rows  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shelfline.llm import fingerprints, licenses, lines, mixing, neardups, sharding  # noqa: E402
from shelfline.llm.textbytes import WordHasher, shingle_set  # noqa: E402

SCHEMA = "doc_id long, text string, source string, rate string, row string, node string"


def documents(spark, texts):
    """Rows whose extra columns clash with names that operators use themselves."""
    return spark.createDataFrame(
        [(n, t, f"s{(n or 0) % 3}" if (n or 1) % 5 else None, "x", "y", "z") for n, t in texts], SCHEMA)


def write(df, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def invented(n, seed, size=60):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeioulnrst") for _ in range(draw.randint(2, 7))) for _ in range(n or size))


@pytest.fixture(scope="module")
def texts():
    draw, out = random.Random(1), []
    for n in range(60):
        out.append((n, invented(draw.randint(5, 90), n)))
    for n in range(60, 100):
        words = out[n % 7][1].split()
        for _ in range(n % 9):
            words[draw.randrange(len(words))] = "changed"
        out.append((n, " ".join(words)))
    odd = [None, "", " \n\t", "one", "One", "two words", "a b c d", "a b c d e", "x" * 5000, invented(4000, 9), "ärger über ñandú 🙂 ende"]
    return out + [(100 + k, t) for k, t in enumerate(odd)] + [(3, out[3][1]), (None, out[5][1]), (200, out[5][1].upper())]


# ------------------------------------------------------------------------- mixing

def test_mix_agrees_with_its_sql_and_comes_near_the_targets(spark, tmp_path, texts):
    folder = write(documents(spark, texts), tmp_path)
    got = rows(mixing.op1_mixing(spark, folder), "doc_id", "source", "size", "source_size", "target", "copies", "taken")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT doc_id, source, size, source_size, target, copies, taken FROM ({mixing.OP1_SQL})").fetchall()
    assert got == sorted(want, key=repr)
    assert all(taken <= 3 * size for _, _, size, _, _, _, taken in got)


def filled(sizes):
    """Targets by handing the excess round until none is above its ceiling."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        shares = sum(weight[s] for s in names if s not in stopped)
        target = {s: 3.0 * sizes[s] if s in stopped else left * weight[s] / shares for s in names}
        above = {s for s in names if s not in stopped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 2000, "c": 5, None: 300}, {"a": 1, "b": 1, "c": 1000}, {"x": 7}, {"a": 0, "b": 5},
    {f"s{n}": n * n + 1 for n in range(40)}])
def test_targets_are_water_filled(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got.keys() == sizes.keys()
    assert all(math.isclose(got[s], t, abs_tol=1e-6) for s, t in filled(sizes).items())


def test_mix_emits_whole_rows(spark, texts):
    docs = documents(spark, texts)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert rows(mixed) == rows(mixing.mix(docs))
    assert mixing.mix(docs.limit(0)).count() == 0


# ----------------------------------------------------------------------- sharding

def jump(key, shards):
    """The published algorithm, step by step."""
    key, b, j = key & (2**64 - 1), -1, 0
    while j < shards:
        b = j
        key = (key * sharding.MULTIPLIER + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    df = spark.range(2000).select(F.xxhash64("id").alias("k"))
    for n in (1, 2, 16, 17, 100):
        assert all(r.s == jump(r.k, n) for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect())


def test_shards_are_numbered_without_gaps(spark, tmp_path, texts):
    out = sharding.op6_sharding(spark, write(documents(spark, texts).repartition(5), tmp_path)).collect()
    assert len(out) == len(texts)
    for shard in {r.shard for r in out}:
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16 for r in out)
    assert {r.size for r in out if r.doc_id == 100} == {1}


# ------------------------------------------------------------------- fingerprints

def test_fingerprints_of_edited_texts(spark, tmp_path):
    texts = [(n, invented(0, n, 40 + 30 * n)) for n in range(12)] + [(20, None), (21, "few words"), (30, invented(0, 3, 130))]
    out = {r.doc_id: r for r in fingerprints.op4_fingerprints(spark, write(documents(spark, texts), tmp_path)).collect()}
    order, whole = sorted(out), {n: t or "" for n, t in texts}
    for n, after in zip(order, order[1:] + order[:1], strict=True):
        text, cut = whole[n], len(whole[n]) // 4
        edited = text[:len(text) - cut] + whole[after][:cut]
        assert out[n].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and out[n].n_chars == len(text)
        assert 0 <= out[n].near_next <= 1 and 0 <= out[n].near_edited <= 1
        if n < 12:
            assert out[n].near_edited > 0.4 and out[n].near_next < 0.2
    assert out[3].fingerprint == out[30].fingerprint


def test_likeness_estimates_containment(spark):
    long = invented(0, 77, 4000)
    words = long.split()
    part, other = " ".join(words[1000:1600]), invented(0, 78, 600)
    got = spark.createDataFrame([(long, part, other)], "a string, b string, c string").select(
        *[fingerprints.sketch(F.col(c)).alias(c) for c in "abc"]).select(
        fingerprints.likeness(F.col("a"), F.col("b")), fingerprints.likeness(F.col("a"), F.col("c"))).first()
    assert got[0] > 0.9 and got[1] < 0.1


def plain_sketch(text):
    """The same sketch by loops over words, with the public hash library."""
    def chained(values):
        seed = 42
        for value in values:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", value), seed & (2 ** 64 - 1))
            seed -= 2 ** 64 if seed >= 2 ** 63 else 0
        return seed

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(w.encode(), 42)))[0]
             for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    found = {chained(words[n:n + 5]) for n in range(max(len(words) - 4, 1))} if words else set()
    return sorted(h for h in found if h < fingerprints.BOUND) or sorted(found)[:1]


def test_sketches_and_likeness_against_loops(spark):
    texts = ["", " \t\n", "one", "Four words ÄÖ Here", "five words are one shingle", "a " * 50, invented(0, 5, 90), invented(0, 5, 90).upper(),
             "ÀB c\x0bd\x0ce f\u00a0g h", invented(0, 9, 8000)]
    pairs = spark.createDataFrame([(n, m, a, b) for n, a in enumerate(texts) for m, b in enumerate(texts)], "n int, m int, a string, b string")
    marked = pairs.select("n", "m", fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    for r in marked.select("*", fingerprints.likeness(F.col("a"), F.col("b")).alias("like"),
                           fingerprints.merged(F.col("a"), F.col("b")).alias("both")).collect():
        a, b = plain_sketch(texts[r.n]), plain_sketch(texts[r.m])
        least = min(len(a), len(b))
        assert r.a == a and r.b == b
        assert r.like == (1.0 if not a and not b else 0.0 if not least else len(set(a) & set(b)) / least)
        everything = sorted(set(a) | set(b))
        assert r.both == ([h for h in everything if h < fingerprints.BOUND] or everything[:1])
        assert r.n != r.m or r.like == 1.0


def test_sketches_of_parts_merge_into_that_of_the_whole(spark):
    words = invented(0, 4, 900).split()
    parts = [" ".join(words[:304]), " ".join(words[300:310]), " ".join(words[306:])]
    got = spark.createDataFrame([(*parts, " ".join(words))], "a string, b string, c string, d string").select(
        *[fingerprints.sketch(F.col(c)).alias(c) for c in "abcd"]).select(
        fingerprints.merged(fingerprints.merged(F.col("a"), F.col("b")), F.col("c")).alias("parts"), "d").first()
    assert got.parts == got.d and len(got.d) > 50


def test_fingerprints_of_odd_tables(spark, tmp_path):
    def run(df, name):
        return fingerprints.op4_fingerprints(spark, write(df, tmp_path / name))

    empty = run(documents(spark, []).limit(0), "empty")
    assert empty.count() == 0 and {"doc_id", "fingerprint", "near_next"} <= set(empty.columns)
    long = invented(0, 6, 40_000)
    texts = [(1, long), (1, long), (2, "a b c"), (None, None), (None, "x")]
    odd = documents(spark, texts).withColumns({"hashes": F.lit(1), "next_id": F.lit(2), "before_id": F.lit(3)})
    out = run(odd, "odd").collect()
    assert len(out) == 5 and all(r.near_edited is not None and r.near_next is not None for r in out)
    hot = [r for r in out if r.doc_id == 1]
    assert hot[0] == hot[1] and hot[0].n_chars == len(long) and len(hot[0].fingerprint.split(".")) > 1000
    alone = run(documents(spark, [(9, "a b c d e f")]), "alone").first()
    assert alone.near_next == 1.0


# ------------------------------------------------------------------------ licenses

def test_license_places_and_suppression(spark):
    texts = [
        (1, "Released under the MIT License. The mit-license, twice."), (2, "Apache License, Version 2.0"), (3, None), (4, ""),
        (5, "This work is licensed under the GNU General Public License, version 3 or any later version."),
        (6, "SPDX-License-Identifier: MPL-2.0"), (7, "Licensed under CC BY-NC 4.0."), (8, "my smith licensee permits"), (1, "mit license")]
    out = licenses.scan(documents(spark, texts)).collect()
    by = {(r.doc_id, r.n_words): r for r in out}
    assert len(out) == len(texts) and out[0].asDict().keys() >= {"source", "rate", "row", "node", "labels", "score"}
    mit = by[1, 9]
    assert (mit.n_base, mit.first_word, mit.last_word, mit.base_labels, mit.labels) == (2, 3, 6, "mit", "mit")
    assert by[2, 5].labels == "apache,apache-2.0" and by[5, 16].labels == "gpl,gpl-3.0" and by[5, 16].base_labels == "gpl"
    assert by[6, 6].labels == "mpl-2.0" and by[6, 6].n_base == 0 and by[6, 6].first_word is None and by[7, 7].labels == "cc-by-nc"
    assert (by[8, 4].labels, by[8, 4].score) == ("", 0.0)
    assert by[3, 0].n_words == by[4, 0].n_words == 0 and by[1, 2].n_base == 1


def test_rules_need_no_words_but_their_own(spark):
    found = {"This program is released under the GPL version 2.": "gpl-2.0", "Distributed under the terms of Apache 2.0.": "apache-2.0",
             "available under BSD-3-Clause": "bsd-3-clause", "covered under MPL 2.0": "mpl-2.0", "under LGPL 2.1": "lgpl-2.1", "AGPL v3": "agpl-3.0",
             "released into the public\ndomain": "public-domain", "under cc  by\nsa 4.0": "cc-by-sa", "under CC0 1.0": "cc0-1.0", "the WTFPL": "wtfpl"}
    out = licenses.scan(documents(spark, list(enumerate(found)))).collect()
    assert {r.doc_id: r.labels for r in out} == dict(enumerate(found.values())) and all(r.score > 0 for r in out)


def test_every_rule_compiles_and_there_are_hundreds():
    rules = licenses.rules()
    assert len(rules) > 300 and [r.priority for r in rules] == sorted(r.priority for r in rules)
    for r in rules:
        re.compile(r.pattern)


# --------------------------------------------------------------------- near duplicates

def components_of(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = {r: min((texts[k][0] for k in range(len(texts)) if root[k] == r and texts[k][0] is not None), default=None) for r in root}
    return sets, [least[r] if sets[k] else texts[k][0] for k, r in enumerate(root)]


def test_near_duplicates_against_all_pairs(spark, texts):
    sets, roots = components_of(texts)
    want = sorted(((n, len(s), r, n == r) for (n, _), s, r in zip(texts, sets, roots, strict=True)), key=repr)
    got = neardups.near_duplicates(documents(spark, texts).repartition(3))
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == want
    assert neardups.near_duplicates(documents(spark, []).limit(0)).count() == 0


def test_large_groups_are_compared_in_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(neardups, "LIST_BLOCK", 2)
    monkeypatch.setattr(neardups, "GROUP_BLOCK", 2)
    _, roots = components_of(texts)
    got = neardups.near_duplicates(documents(spark, texts)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(
        ((n, r) for (n, _), r in zip(texts, roots, strict=True)), key=repr)


def test_one_row_of_each_group_stays(spark, texts):
    docs = documents(spark, texts)
    kept = neardups.keep_one(docs).collect()
    _, roots = components_of(texts)
    sets, _ = components_of(texts)
    groups = {r for s, r in zip(sets, roots, strict=True) if s}
    alone = [n for (n, _), s in zip(texts, sets, strict=True) if not s]
    assert sorted(r.doc_id for r in kept) == sorted([*groups, *alone])


def test_word_hashes_do_not_depend_on_the_layout():
    import pyarrow as pa

    long = invented(0, 5, 3000)
    hasher = WordHasher()
    alone = [h.tolist() for h in hasher.of_texts(pa.array([long]))][0]
    among = [h.tolist() for h in hasher.of_texts(pa.array(["", "a  b", None, long, "\tb a "]))]
    assert among[3] == alone and among[0] == among[2] == [] and among[1] == among[4][::-1]
    assert [h.tolist() for h in hasher.of_texts(pa.array([long.upper()]))][0] == alone
    assert hasher._long(long.encode()).tolist() == alone
    assert len(shingle_set(hasher.block(__import__("numpy").frombuffer(b"a b", "uint8"))[0], 5)) == 1


# ---------------------------------------------------------------------------- lines

def test_later_repeats_of_runs_go(spark):
    passage = "\n".join(invented(0, k, 12) + "." for k in range(5))
    own = [invented(0, 100 + k, 15) for k in range(6)]
    texts = [(1, f"{own[0]}\n{passage}\n{own[1]}"), (2, f"{own[2]}\n{passage}\n{own[3]}"), (3, f"{own[4]} short.\n{own[5]}"),
             (4, passage), (5, None), (6, ""), (1, f"{own[0]}\n{passage}\n{own[1]}"), (7, f"{passage}\n{passage}")]
    out = sorted(((r.row.doc_id, r.cut.text) for r in lines.dedupe_lines(documents(spark, texts)).collect()), key=repr)
    assert out == sorted([(1, texts[0][1]), (1, texts[0][1]), (2, f"{own[2]}\n{own[3]}"), (3, texts[2][1]), (4, ""), (5, None),
                          (6, ""), (7, "")], key=repr)
    docs = documents(spark, texts)
    kept = lines.dedupe(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 3, 5, 6]
    assert lines.dedupe(docs.limit(0)).count() == 0


def test_passages_of_common_lines_go(spark):
    common = [invented(0, 300 + k, 7) + "." for k in range(5)]
    # Each line occurs first on its own, between other lines than in the passage.
    alone = [(k, f"{invented(0, 400 + k, 9)}.\n{c}\n{invented(0, 500 + k, 9)}.") for k, c in enumerate(common)]
    passage = "\n".join(common)
    out = {r.row.doc_id: r.cut.text for r in lines.dedupe_lines(documents(spark, [*alone, (10, passage), (11, f"own words\n{passage}\nat the end")])).collect()}
    assert out == {**dict(alone), 10: passage, 11: "own words\nat the end"}


def test_a_long_line_goes_by_itself(spark):
    line, short = invented(60, 600), invented(0, 601, 19)
    texts = [(1, f"{invented(0, 602, 9)}\n{line}\n{short}\nend"), (2, f"{invented(0, 603, 9)}\n{line}\nother\n{short}\nlast"), (3, line), (4, short)]
    out = {r.row.doc_id: r.cut.text for r in lines.dedupe_lines(documents(spark, texts)).collect()}
    assert out == {1: texts[0][1], 2: texts[1][1].replace(f"{line}\n", ""), 3: "", 4: short}


def test_short_repeats_and_clean_texts_stay(spark):
    texts = [(n, f"Hello there. Good day.\n{invented(0, n, 40)}\nBye now.") for n in range(5)]
    assert sorted(r.text for r in lines.dedupe(documents(spark, texts)).collect()) == sorted(t for _, t in texts)


def test_windows_always_share_a_fingerprint():
    import numpy as np

    draw = np.random.default_rng(3)
    for _ in range(50):
        hashes, owner, sizes = draw.integers(0, 9, 40), np.sort(draw.integers(0, 3, 40)), draw.integers(1, 12, 40)
        first, last = lines.windows(owner, sizes)
        picked = lines.fingerprints(hashes, first, last)
        spans = set(zip(first.tolist(), last.tolist(), strict=True))
        for k in range(40):
            ahead = next((e for e in range(k, 40) if sizes[k:e + 1].sum() >= 20), None)
            back = next((b for b in range(k, -1, -1) if sizes[b:k + 1].sum() >= 20), None)
            assert ahead is None or owner[ahead] != owner[k] or (k, ahead) in spans
            assert back is None or owner[back] != owner[k] or (back, k) in spans
        for a, b, p in zip(first.tolist(), last.tolist(), picked.tolist(), strict=True):
            assert owner[a] == owner[b] and p == a + int(np.argmin(hashes[a:b + 1]))
    # Lines of six words: windows of four lines, and less than half of the lines are posted.
    long = draw.integers(0, 1 << 62, 20_000)
    picked = lines.fingerprints(long, *lines.windows(np.zeros(20_000, int), np.full(20_000, 6)))
    assert len(np.unique(picked)) < 10_000


def runs_deleted(docs, least=20):
    """Lines inside a run of ``least`` words that occurs earlier at one offset, over all pairs of places."""
    out = []
    places = [(d, n) for d, doc in enumerate(docs) for n in range(len(doc))]
    for d, doc in enumerate(docs):
        gone = set()
        for n in range(len(doc)):
            for e, m in places:
                if (e, m) >= (d, n) or docs[e][m] != doc[n]:
                    continue
                a = 0
                while min(n, m) - a > 0 and docs[e][m - a - 1] == doc[n - a - 1]:
                    a += 1
                b = 0
                while n + b + 1 < len(doc) and m + b + 1 < len(docs[e]) and docs[e][m + b + 1] == doc[n + b + 1]:
                    b += 1
                if sum(len(line.split()) for line in doc[n - a:n + b + 1]) >= least:
                    gone.add(n)
        out.append("\n".join(line for k, line in enumerate(doc) if k not in gone))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deleted_lines_are_those_of_earlier_runs(spark, seed):
    draw = random.Random(seed)
    known = [invented(0, 1000 + k, draw.choice([1, 3, 5, 7, 9, 12, 25])) for k in range(25)]
    passages = [[draw.choice(known) for _ in range(draw.randint(2, 7))] for _ in range(8)]
    docs = [[line for _ in range(draw.randint(1, 5)) for line in
             (draw.choice(passages) if draw.random() < 0.5 else [draw.choice(known) if draw.random() < 0.5 else invented(0, draw.random(), 6)])]
            for _ in range(60)]
    found = {r.row.doc_id: r.cut.text for r in lines.dedupe_lines(
        documents(spark, [(n, "\n".join(d)) for n, d in enumerate(docs)]).repartition(3)).collect()}
    assert [found[n].rstrip("\n") for n in range(60)] == runs_deleted(docs)


def test_a_passage_stitched_from_known_pairs_stays(spark):
    line = [invented(0, 700 + k, 4) for k in range(7)]
    pairs = [(k, f"{invented(0, 800 + k, 9)}\n{line[k]}\n{line[k + 1]}\n{invented(0, 900 + k, 9)}") for k in range(6)]
    whole = (9, "\n".join(line))
    out = {r.row.doc_id: r.cut.text for r in lines.dedupe_lines(documents(spark, [*pairs, whole])).collect()}
    assert out == dict([*pairs, whole])


def test_lines_end_with_breaks_and_sentences_in_texts_of_any_size(monkeypatch):
    texts = [b"A b.  C d\n\n e\nf! g", b"", b" \n", b"one", "\u00e4 b? c\n".encode()]
    owner, hashes, at, until = lines.lines_of(WordHasher(), texts)
    assert [(int(o), texts[o][a:b]) for o, a, b in zip(owner, at, until, strict=True)] == [
        (0, b"A b.  "), (0, b"C d\n\n "), (0, b"e\n"), (0, b"f! "), (0, b"g"), (3, b"one"), (4, "\u00e4 b? ".encode()), (4, b"c\n")]
    monkeypatch.setattr(lines, "BLOCK_BYTES", 3)
    assert [x.tolist() for x in lines.lines_of(WordHasher(), texts)] == [x.tolist() for x in (owner, hashes, at, until)]
