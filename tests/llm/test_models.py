"""Vectors, classifiers, pieces and the pipeline on small fixtures."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from conftest import rows  # noqa: E402

import corpus_pipeline  # noqa: E402
from shelfline.llm import embeddings, pieces, quality, toxicity  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


# ------------------------------------------------------------------------- vectors

def linked(vectors):
    """Links and components by comparing all pairs."""
    n_links, root = [0] * len(vectors), list(range(len(vectors)))
    good = [v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
            for _, label, v in vectors]
    for a in range(len(vectors)):
        for b in range(a):
            va, vb = vectors[a], vectors[b]
            if good[a] and good[b] and va[1] == vb[1] and len(va[2]) == len(vb[2]):
                x, y = np.array(va[2], float), np.array(vb[2], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    n_links[a] += 1
                    n_links[b] += 1
                    old, new = root[a], root[b]
                    root = [new if r == old else r for r in root]
    least = {r: min(vectors[k][0] for k in range(len(vectors)) if root[k] == r) for r in root}
    return sorted((v[0], n_links[k], least[root[k]], v[0] == least[root[k]]) for k, v in enumerate(vectors))


@pytest.mark.parametrize("block", [1024, 3])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BUCKET_BLOCK", block)
    monkeypatch.setattr(embeddings, "GROUP_BLOCK", block)
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((6, 16))
    vectors = [(n, n % 3, (centres[n % 6] + draw.standard_normal(16) * 0.12 * (n % 4)).astype(np.float32).tolist()) for n in range(120)]
    vectors += [(200 + n, 0, vectors[0][2]) for n in range(5)]
    vectors += [(300, 0, None), (301, None, vectors[0][2]), (302, 0, [0.0] * 16), (303, 0, [float("nan")] * 16), (304, 0, []),
                (305, 0, [None, *vectors[0][2][1:]]), (306, 0, [float("inf"), *vectors[0][2][1:]]), (307, 0, vectors[0][2][:8])]
    df = spark.createDataFrame([(v, label, e, "x") for v, label, e in vectors], "vec_id long, label int, embedding array<float>, node string")
    assert rows(embeddings.near_vectors(df), "vec_id", "n_links", "component_id", "kept") == sorted(linked(vectors), key=repr)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


# ---------------------------------------------------------------------- classifiers

def test_quality_is_learnt_and_long_texts_are_scored_whole(spark, monkeypatch):
    draw = random.Random(2)
    def words(n):
        return ["".join(draw.choice("aeioulnrst") for _ in range(draw.randint(2, 7))) for _ in range(n)]

    good = [" ".join(words(60)) for _ in range(150)]
    bad = [" ".join(w + draw.choice(["$$$", "%%%"]) for w in words(60)) for _ in range(50)]
    net = quality.train([(t, 1) for t in good[:100]] + [(t, 0) for t in bad[:35]])
    assert np.mean(net.score([t.encode() for t in good[100:]]) >= 0.7) > 0.9
    assert np.mean(net.score([t.encode() for t in bad[35:]]) < 0.7) > 0.9
    many = [good[0].encode(), b"", bad[0].encode(), b"x"]
    alone = [net.score([t])[0] for t in many]
    assert np.allclose(net.score(many), alone)
    text = " ".join(good).encode() + bad[0].encode()
    whole = net.score([text])[0]
    monkeypatch.setattr(quality, "PIECE", 1000)
    assert np.isclose(net.score([text])[0], whole)
    df = spark.createDataFrame([(1, None), (2, ""), (None, "a"), (2, "")], "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in quality.scores(df, net.score).collect())
    assert 0 <= quality.train([]).score([b"a"])[0] <= 1 and quality.train([("a", 1)]).score([b""])[0] > 0.9


def test_labelled_texts_are_learnt_whole(spark, monkeypatch):
    text = "plain words " * 20_000 + "the passage"
    docs = spark.createDataFrame([(n, text) for n in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, 0, 1) for n in range(8)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "train", seen.extend)
    quality.fit_quality(docs, labels)
    assert seen and all(pair == (text, 0) for pair in seen)
    features, _, goal = toxicity.marked_sample(docs, labels)
    last = toxicity.word_list(toxicity.WordHasher(toxicity.is_no_letter()), "passage")
    assert len(goal) and all(len(toxicity.positions(f, last)) == 1 for f in features)


def test_pieces_of_a_long_text_have_no_end_inside(monkeypatch):
    draw = np.random.default_rng(6)
    net = quality.Network(np.ones((256, quality.WIDTH), np.float32), np.zeros((2, quality.STEP * quality.WIDTH, quality.FILTERS), np.float32),
                          np.zeros(quality.FILTERS, np.float32), np.ones(quality.FILTERS, np.float32), np.zeros(1, np.float32))
    net.codes[0] = -1
    net.filters[1] = -1  # answers to zeros after the text, and by the next line to what is before them
    net.filters[0] = draw.normal(0, 1, net.filters[0].shape)
    net.codes[1:] = draw.normal(1, 0.2, (255, quality.WIDTH))
    for size in (4096, 4099, 4103, 4104, 4105):
        text = bytes(draw.integers(32, 127, size).astype(np.uint8))
        monkeypatch.setattr(quality, "PIECE", 1 << 19)
        blocks = quality.in_blocks(text)
        whole = net.pooled(text)
        assert np.allclose(whole, np.maximum(net.responses(blocks).max(axis=0), 0))
        monkeypatch.setattr(quality, "PIECE", 1024)
        assert np.allclose(net.pooled(text), whole)


def test_quality_and_toxicity_hold_out_their_folds(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for query, label, wanted in ((quality.op5_quality, "quality", 0.85), (toxicity.op9_toxicity, "toxic", 0.9)):
        out = query(spark, FOLDER).join(labels, "doc_id").where("held_out").collect()
        assert len(out) > 50 and np.mean([r.predicted == r[label] for r in out]) >= wanted


def test_label_model_follows_accurate_voters():
    draw = np.random.default_rng(1)
    toxic = draw.random(4000) < 0.1
    votes = np.zeros((4000, toxicity.VOTERS), int)
    for v in range(8):
        votes[:, v] = np.where(toxic, draw.random(4000) < 0.6, draw.random(4000) < 0.01)
    votes[:, 8] = votes[:, 7]  # repeats another voter
    votes[:, 9] = draw.random(4000) < 0.3  # knows nothing
    masks = (votes << np.arange(toxicity.VOTERS)).sum(axis=1)
    kinds, counts = np.unique(masks, return_counts=True)
    none = np.zeros(len(kinds))
    model = toxicity.fit_label_model(kinds, counts.astype(float), none, none)
    found = model.posterior(toxicity.votes_of(masks)) > 0.5
    assert (found == toxic).mean() > 0.97
    assert {(7, 8), (8, 7)} & {(v, int(p)) for v, p in enumerate(model.parents[1])}


def test_toxicity_without_labels_and_on_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "you idiot and moron", "x"), (2, None, "x"), (3, "", "x"), (None, "fine words", "x"), (1, "you idiot and moron", "x")],
        "doc_id long, text string, label string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert all(0 <= s <= 1 for s in model.score([b"", b"you idiot", b"fine"]))
    assert toxicity.reject_toxic(docs, labels).columns == docs.columns
    assert toxicity.reject_toxic(docs.limit(0), labels).count() == 0


def test_toxicity_learns_from_unmarked_documents_and_not_from_wrong_marks(spark):
    draw = random.Random(4)
    words = ["".join(draw.choice("bcdfgk") + draw.choice("aeiou") for _ in range(4)) for _ in range(300)]
    def plain():
        return " ".join(draw.choice(words) for _ in range(40))

    toxic = [f"{plain()} idiot worthless scum {plain()} zorblax" for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(toxic + [plain() for _ in range(600)])), "doc_id long, text string")
    # No marked document has the word that comes with insults, and a few insults are marked clean.
    labels = spark.createDataFrame([(n, 1, 0) for n in [0, 1, 2, *range(60, 360)]], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert np.mean(model.score([t.encode() for t in toxic]) >= 0.5) > 0.9
    assert model.score([b"zorblax"])[0] > 2 * model.score([words[0].encode()])[0]
    assert np.mean(model.score([plain().encode() for _ in range(100)]) >= 0.5) < 0.05


# ---------------------------------------------------------------------------- pieces

TEXTS = ["Hello  wörld\n\nfoo ﬁ Å", "", " ", "   a", "a" * 300, "日本語テキスト🙂\x00\t", "x ▁ y", "https://example.org/" + "abc/de?f=%20" * 20,
         "internationalization counterrevolutionary", "\n", "ends with spaces   "]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def test_pieces_without_dropout_are_the_librarys(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    encoder = pieces.Encoder(vocabulary, 0.0)
    for text in TEXTS:
        if pieces.SPACE not in text:
            assert encoder.encode_text(text).tolist() == model.encode(text)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.7, 1.0])
def test_pieces_decode_to_the_text(vocabulary, dropout, monkeypatch):
    encoder = pieces.Encoder(vocabulary, dropout)
    for text in TEXTS:
        assert encoder.decode(encoder.encode_text(text, 5)) == text
    assert encoder.encode_text(TEXTS[0]).tolist() == encoder.encode_text(TEXTS[0]).tolist()
    monkeypatch.setattr(pieces, "STRETCH", 7)
    for text in TEXTS:
        assert encoder.decode(encoder.encode_text(text, 5)) == text


def test_seeds_vary_the_pieces_and_long_words_take_the_same_merges(vocabulary, monkeypatch):
    text = " ".join(TEXTS[8] for _ in range(20))
    found = {tuple(pieces.Encoder(vocabulary, 0.2, seed).encode_text(text).tolist()) for seed in range(4)}
    assert len(found) == 4
    encoder = pieces.Encoder(vocabulary, 0.2)
    rows_ = encoder.encode_text(text).tolist()
    monkeypatch.setattr(pieces, "LONG_WORD", 1)
    assert encoder.encode_text(text).tolist() == rows_


def test_every_occurrence_and_copy_is_drawn_by_itself(spark, vocabulary):
    word = " counterrevolutionary"
    encoder = pieces.Encoder(vocabulary, 0.2)
    text = (word * 500)[1:]
    ids, ends = encoder.encode([(3, " " + text)])
    found, spelled = set(), []
    for n in ids.tolist():
        spelled.append(n)
        if encoder.decode_bytes(np.array(spelled)).decode() == word:
            found.add(tuple(spelled))
            spelled = []
    assert not spelled and len(found) > 50
    # Shared outcomes are those of words drawn alone, each by its own key.
    keys = pieces.mixed(pieces.mixed(np.full(500, 3, np.uint64) * pieces.GOLDEN + encoder.seed) + np.arange(500, dtype=np.uint64) * pieces.OTHER)
    assert encoder.encode_words([word] * 500, keys)[0].tolist() == ids.tolist()
    docs = spark.createDataFrame([(1, text), (1, text), (1, text), (2, text)], "doc_id long, text string")
    assert len({tuple(r.ids) for r in pieces.encode_documents(docs).collect()}) == 4


def agenda(encoder, word, row_key):
    """Merges of one word straight from the definition, drawing for each candidate as it comes up."""
    words = encoder.words
    ids = [int(words.chars[ord(c)]) for c in word]
    starts = list(range(len(ids)))
    while True:
        found = []
        for k in range(len(ids) - 1):
            into = int(words.look_up(np.array([ids[k]]), np.array([ids[k + 1]]))[0])
            if into >= 0 and not (encoder.skip_below and encoder.skipped(
                    np.array([row_key]), np.array([starts[k]]), np.array([into]))[0]):
                found.append((int(words.rank[into]), k, into))
        if not found:
            return ids
        _, k, into = min(found)
        ids[k:k + 2], starts[k:k + 2] = [into], [starts[k]]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6])
def test_dropout_agrees_with_a_plain_agenda(vocabulary, dropout):
    encoder = pieces.Encoder(vocabulary, dropout)
    words = " the theatre counterrevolutionary internationalisation in a aaaaaaa the the recombination\u00e4\u00f6 the x".split(" ")[1:] * 12
    text = " " + " ".join(words)
    keys = pieces.mixed(pieces.mixed(np.full(len(words), 5, np.uint64) * pieces.GOLDEN + encoder.seed) + np.arange(len(words), dtype=np.uint64) * pieces.OTHER)
    want = [n for word, key in zip(words, keys, strict=True) for n in agenda(encoder, " " + word, key)]
    assert encoder.encode([(5, text)])[0].tolist() == want


def test_copies_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pieces, "COPIES", 3)
    docs = spark.createDataFrame([(1, "a")] * 8 + [(None, "b")] * 4 + [(None, None)] * 2 + [(2, "a"), (None, "c")], "doc_id long, text string")
    got = rows(pieces.numbered_copies(docs).select("doc_id", "text", "copy"))
    want = [(1, "a", n + 1) for n in range(8)] + [(None, "b", n + 1) for n in range(4)] + [(None, None, 1), (None, None, 2), (2, "a", 1), (None, "c", 1)]
    assert got == sorted(want, key=repr)


def test_documents_are_encoded_and_decoded(spark):
    texts = [(n, t, "x") for n, t in enumerate(TEXTS)] + [(50, None, "x"), (None, "no id", "x"), (0, TEXTS[0], "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, ids string")
    out = pieces.encode_documents(docs)
    assert all(r.lossless for r in out.collect())
    assert rows(pieces.decode_documents(out)) == sorted([(n, t) for n, t, _ in texts], key=repr)
    assert pieces.encode_documents(docs.limit(0)).count() == 0


# -------------------------------------------------------------------------- pipeline

def test_pipeline_stages_hand_documents_on(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = docs.cache()
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3] > 0
    out = corpus_pipeline.STAGES[4][1](spark, docs, folder)
    assert out.count() == counts[4] and out.where("NOT lossless").count() == 0
