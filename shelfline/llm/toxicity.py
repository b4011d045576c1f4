"""Toxicity by weak supervision.

1. Voters: word lists written by hand, word lists and word stems mined from a bounded
   sample of labelled rows, and patterns of shouting. Each fires on a text or not.
2. Every document is voted on; documents are counted by the set of voters that fired,
   at most 2 ** 12 counts.
3. A generative label model is fitted to those counts by expectation maximisation: the
   class prior, how often each voter fires in either class, and, as voters repeat each
   other, the strongest correlations between them, a tree per class.
4. A linear classifier over words and word stems learns the model's posteriors of
   documents drawn from the whole corpus, marked or not: at most 6,000 that the model
   holds toxic and 6,000 others, outside the held-out fold, each weighed by the
   documents it stands for. Marks mine words and place the label model's classes, but
   are no targets. Whole texts are reduced to their words inside Spark tasks, and
   whole texts of any length are scored.

Defined cases: null and empty texts have no words and get the score of the bias;
documents without a label are voted on, drawn and scored like others; repeated rows
(same doc_id and text) count each as votes, are drawn once and score alike; labels without a document are ignored; without a toxic label
only the lists written by hand vote; extra columns do no harm; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import frees_memory, in_small_batches, table
from shelfline.llm.quality import scores, sigmoid, slices
from shelfline.llm.samples import fold, picked_labels
from shelfline.llm.textbytes import WordHasher, is_no_letter
from shelfline.session import materialize

SAMPLE_ROWS = 6000
DRAWN_ROWS = 6000
TIED = 4.0
FOLDS, HELD_OUT = 5, 0
TOXIC = 0.5
STEMS = (4, 5, 6)
FEATURES = 1 << 14
EVIDENCE = 9.0
ROUNDS = 30

# Words that insult or threaten, by kind.
LEXICONS = (
    "idiot moron imbecile cretin fool dunce halfwit dimwit simpleton nitwit blockhead",
    "stupid dumb brainless mindless clueless ignorant braindead retarded",
    "scum trash garbage filth vermin parasite maggot lowlife",
    "worthless pathetic useless disgusting repulsive loathsome despicable",
    "loser clown freak creep pervert coward liar jerk bastard",
    "kill murder shoot hate despise exterminate",
)
MINED = 4
PATTERNS = 2
VOTERS = len(LEXICONS) + MINED + PATTERNS


def word_list(hasher: WordHasher, words: str) -> np.ndarray:
    """Hashes of whole words; the hasher's stems of them are left out."""
    plain = WordHasher(hasher.space)
    return plain.block(np.frombuffer(words.encode(), np.uint8))[0]


def shouting(text: bytes) -> int:
    """Bits of the two pattern voters: many exclamation marks, mostly capital letters."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return 0
    capitals, small = int(((data >= 65) & (data <= 90)).sum()), int(((data >= 97) & (data <= 122)).sum())
    return int((data == 33).sum() * 100 > len(data)) | (int(capitals > small) << 1)


@dataclass
class Voters:
    """Hashes of words and stems, sorted, and the bits of the voters that each one makes fire."""

    hashes: np.ndarray
    bits: np.ndarray

    def masks(self, texts: pa.Array) -> Iterator[int]:
        hasher = WordHasher(is_no_letter(), STEMS)
        for value, found in zip(texts, hasher.of_texts(texts), strict=True):
            mask = int(np.bitwise_or.reduce(self.bits[positions(self.hashes, found)])) if len(found) else 0
            text = value.as_buffer() if value.is_valid else b""
            yield mask | shouting(text) << (VOTERS - PATTERNS)

    def mask_of(self, features: np.ndarray, shouts: int) -> int:
        """The same for the features and pattern votes of one text."""
        return int(np.bitwise_or.reduce(self.bits[positions(self.hashes, features)])) | shouts << (VOTERS - PATTERNS)

    def vote(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            mask = pa.array(list(self.masks(batch.column("text"))), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("open"), batch.column("key"), mask], names=["open", "key", "mask"])


def positions(known: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Places in a sorted array of the hashes that are in it."""
    if not len(known):
        return np.zeros(0, int)
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    return at[known[at] == found]


def features_and_shouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to id, the distinct hashes of the whole text's words and stems, and its pattern votes."""
    hasher = WordHasher(is_no_letter(), STEMS)
    for batch in slices(batches):
        found = [np.unique(f).tobytes() for f in hasher.of_texts(batch.column("text"))]
        shouts = [shouting(v.as_buffer() if v.is_valid else b"") for v in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(found, pa.binary()), pa.array(shouts, pa.int32())], names=["id", "features", "shouts"])


def featured(texts: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """By id, the features and pattern votes of (id, text); of several texts of an id, those of one set by the features."""
    found = texts.mapInArrow(frees_memory(features_and_shouts), "id long, features binary, shouts int")
    one = found.groupBy("id").agg(F.min_by(F.struct("features", "shouts"), F.xxhash64("features", "shouts")).alias("s"))
    rows = one.select("id", "s.*").toArrow()
    return {k: (np.frombuffer(f.as_buffer(), np.uint64), s) for k, f, s in zip(
        rows.column("id").to_pylist(), rows.column("features"), rows.column("shouts").to_pylist(), strict=True)}


def counts_by_label(features: list[np.ndarray], goal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, texts with it, toxic ones of them) in order, from sorted features of texts.

    Hashes are counted a range at a time, so that the driver holds one copy of the
    sample and of a sixteenth part of it.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))]
    for part in range(16):
        low, high = np.uint64(part << 60), np.uint64((part << 60) + (1 << 60) - 1)
        slices_ = [f[np.searchsorted(f, low):np.searchsorted(f, high, side="right")] for f in features]
        every, total = np.unique(np.concatenate([np.zeros(0, np.uint64), *slices_]), return_counts=True)
        known, toxic = np.unique(
            np.concatenate([np.zeros(0, np.uint64), *[f for f, g in zip(slices_, goal, strict=True) if g]]), return_counts=True)
        hits = np.zeros(len(every))
        hits[np.searchsorted(every, known)] = toxic
        found.append((every, total, hits))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def evidence(features: list[np.ndarray], goal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per feature: texts of either label with it, and the log-likelihood ratio of its tie to the label (signed)."""
    every, total, hits = counts_by_label(features, goal)
    rate = np.clip(goal.mean() if len(goal) else 0.5, 1e-6, 1 - 1e-6)
    share = np.clip(hits / np.maximum(total, 1), 1e-9, 1 - 1e-9)
    ratio = hits * np.log(share / rate) + (total - hits) * np.log((1 - share) / (1 - rate))
    return every, hits, total - hits, np.where(share >= rate, ratio, -ratio)


def build_voters(features: list[np.ndarray], goal: np.ndarray) -> Voters:
    hasher = WordHasher(is_no_letter(), STEMS)
    lists = [word_list(hasher, words) for words in LEXICONS]
    every, toxic, clean, ratio = evidence(features, goal)
    strong = np.flatnonzero((ratio >= EVIDENCE) & (toxic >= 10 * clean) & (toxic >= 3))
    # Neighbours in strength often stem from the same words: they go to different voters.
    for n, k in enumerate(strong[np.argsort(-ratio[strong], kind="stable")]):
        if n < MINED:
            lists.append(every[[k]])
        else:
            lists[len(LEXICONS) + n % MINED] = np.append(lists[len(LEXICONS) + n % MINED], every[k])
    bits: dict[int, int] = {}
    for bit, hashes in enumerate(lists):
        for h in hashes.tolist():
            bits[h] = bits.get(h, 0) | 1 << bit
    known = np.array(sorted(bits), np.uint64)
    return Voters(known, np.array([bits[h] for h in known.tolist()], np.int32))


@dataclass
class LabelModel:
    """Class prior and, per class, a tree over the voters with the chance of each given its parent."""

    prior: float
    parents: np.ndarray  # 2 x VOTERS, -1 for the root
    chances: np.ndarray  # 2 x VOTERS x 2: of firing, by whether the parent fired

    def log_likelihood(self, votes: np.ndarray) -> np.ndarray:
        found = np.zeros((2, len(votes)))
        for y in range(2):
            for v in range(VOTERS):
                parent = self.parents[y, v]
                given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
                p = self.chances[y, v][given]
                found[y] += np.log(np.where(votes[:, v] == 1, p, 1 - p))
        return found

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        clean, toxic = self.log_likelihood(votes)
        return sigmoid(toxic - clean + np.log(self.prior / (1 - self.prior)))


def votes_of(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(VOTERS)) & 1


def strongest_tree(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Parents in the spanning tree of greatest mutual information between voters."""
    total = max(weight.sum(), 1e-12)
    one = (weight[:, None] * votes).sum(0) / total
    both = (votes * weight[:, None]).T @ votes / total
    gain = np.zeros((VOTERS, VOTERS))
    for a, b, joint in ((1, 1, both), (1, 0, one[:, None] - both), (0, 1, one[None, :] - both), (0, 0, 1 - one[:, None] - one[None, :] + both)):
        pa_, pb = (one if a else 1 - one)[:, None], (one if b else 1 - one)[None, :]
        joint = np.clip(joint, 1e-12, 1)
        gain += joint * np.log(joint / np.clip(pa_ * pb, 1e-12, 1))
    parents, inside = np.full(VOTERS, -1), [0]
    while len(inside) < VOTERS:
        rest = [v for v in range(VOTERS) if v not in inside]
        edges = gain[np.ix_(inside, rest)]
        k = np.unravel_index(edges.argmax(), edges.shape)
        parents[rest[k[1]]] = inside[k[0]]
        inside.append(rest[k[1]])
    return parents


def marks(masks: np.ndarray, sample_masks: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per set of voters, how many texts of the sample have it and how many of these are marked toxic."""
    seen = np.array([(sample_masks == m).sum() for m in masks], float)
    return seen, np.array([goal[sample_masks == m].sum() for m in masks], float)


def fit_label_model(masks: np.ndarray, counts: np.ndarray, seen: np.ndarray, seen_toxic: np.ndarray) -> LabelModel:
    """Expectation maximisation over the counts; the marks of the sample's texts stay as they are."""
    votes = votes_of(masks)
    words = votes[:, :VOTERS - PATTERNS].sum(axis=1)
    guess = np.where(words > 0, 0.9, 0.02)
    # A few wrong marks must not teach either class that its rare voters fire together.
    smooth = max(10.0, 0.002 * counts.sum())
    toxic = (seen_toxic + guess) / (seen + 1)
    model = LabelModel(0.1, np.full((2, VOTERS), -1), np.full((2, VOTERS, 2), 0.5))
    for _ in range(ROUNDS):
        prior = float(np.clip((counts * toxic).sum() / max(counts.sum(), 1), 1e-4, 0.5))
        parents, chances = np.full((2, VOTERS), -1), np.zeros((2, VOTERS, 2))
        for y, share in ((0, 1 - toxic), (1, toxic)):
            weight = counts * share + 1e-9
            parents[y] = strongest_tree(votes, weight)
            for v in range(VOTERS):
                given = votes[:, parents[y, v]] if parents[y, v] >= 0 else np.zeros(len(votes), int)
                whole = (weight * votes[:, v]).sum() / max(weight.sum(), 1e-12)
                for k in range(2):
                    here = weight * (given == k)
                    chances[y, v, k] = np.clip(((here * votes[:, v]).sum() + smooth * whole) / (here.sum() + smooth), 1e-3, 0.98)
        model = LabelModel(prior, parents, chances)
        toxic = (seen_toxic + np.maximum(counts - seen, 0) * model.posterior(votes)) / np.maximum(counts, seen)
    return model


@dataclass
class Linear:
    """A linear classifier over the words and stems present in a text."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        hasher = WordHasher(is_no_letter(), STEMS)
        out = np.zeros(len(texts))
        for n, found in enumerate(hasher.of_texts(pa.array(texts, pa.binary()))):
            out[n] = self.weights[np.unique(positions(self.hashes, found))].sum()
        return sigmoid(out + self.bias)


def train_linear(features: list[np.ndarray], goal: np.ndarray, stands_for: np.ndarray, steps: int = 500) -> Linear:
    """Logistic regression with squared penalty on the features most tied to a goal of at least one half."""
    every, toxic, clean, ratio = evidence(features, (goal >= 0.5).astype(int))
    # Only features tied to toxicity: weights against it would add up in long texts.
    often = np.flatnonzero((toxic >= 3) & (ratio >= TIED))
    known = np.sort(every[often[np.argsort(-ratio[often], kind="stable")[:FEATURES]]])
    rows, columns = [], []
    for n, f in enumerate(features):
        at = positions(known, f)
        rows.append(np.full(len(at), n, np.int32))
        columns.append(at.astype(np.int32))
    row, column = np.concatenate(rows or [np.zeros(0, np.int32)]), np.concatenate(columns or [np.zeros(0, np.int32)])
    del rows, columns
    weights, rate = np.zeros(len(known)), float(np.clip(np.average(goal, weights=stands_for) if len(goal) else 0.05, 1e-3, 1 - 1e-3))
    bias = float(np.log(rate / (1 - rate)))
    speed, bias_speed = np.full(len(known), 1e-6), 1e-6
    for _ in range(steps):
        error = (sigmoid(np.bincount(row, weights[column], minlength=len(goal)) + bias) - goal) * stands_for
        slope = np.bincount(column, error[row], minlength=len(known)) + 0.005 * weights
        speed += slope * slope
        weights -= 0.3 * slope / np.sqrt(speed)
        bias_speed += error.sum() ** 2
        bias -= 0.3 * error.sum() / np.sqrt(bias_speed)
    return Linear(known, weights, bias)


def marked_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], list[int], np.ndarray]:
    """Features, pattern votes and marks of at most SAMPLE_ROWS marked documents outside the held-out fold."""
    picked = {r.id_: r.label for r in picked_labels(labels, "toxic", FOLDS, HELD_OUT, SAMPLE_ROWS).collect()}
    ids = docs.sparkSession.createDataFrame(sorted(picked), "long").withColumnRenamed("value", "id_")
    found = featured(docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(ids), F.col("id") == F.col("id_")).select("id", "text"))
    known = sorted(found)
    return [found[k][0] for k in known], [found[k][1] for k in known], np.array([picked[k] for k in known], int)


def draw(voted: DataFrame, toxic_masks: list[int]) -> tuple[dict[int, int], dict[bool, int]]:
    """Masks by key of the documents drawn, and how many distinct documents there are on either side."""
    drawn, there = {}, {}
    distinct = voted.where("open").groupBy("key").agg(F.max("mask").alias("mask"))
    for side in (True, False):
        held = F.col("mask").isin(toxic_masks) if toxic_masks else F.lit(False)
        part = distinct.where(held if side else ~held)
        there[side] = part.count()
        # Keys are hashes: the least ones are a draw that does not depend on the layout.
        drawn |= {r.key: r.mask for r in part.orderBy(F.xxhash64("key"), "key").limit(DRAWN_ROWS).collect()}
    return drawn, there


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Linear:
    """Voters from the marked sample, the label model from the votes on all documents, the classifier from its posteriors."""
    features, shouts, goal = marked_sample(docs, labels)
    voters = build_voters(features, goal)
    marked = np.array([voters.mask_of(f, s) for f, s in zip(features, shouts, strict=True)], int)
    del features
    pa.default_memory_pool().release_unused()
    keyed = in_small_batches(docs).select(
        (fold(F.col("doc_id"), FOLDS) != HELD_OUT).alias("open"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("key"), "text")
    voted = materialize(keyed.mapInArrow(frees_memory(voters.vote), "open boolean, key long, mask int"), "votes")
    counted = voted.groupBy("mask").agg(F.count(F.lit(1)).alias("n")).collect()
    masks = np.array([r["mask"] for r in counted], int)
    model = fit_label_model(masks, np.array([r["n"] for r in counted], float), *marks(masks, marked, goal))
    chance = dict(zip(masks.tolist(), model.posterior(votes_of(masks)).tolist(), strict=True))
    drawn, there = draw(voted, [m for m, p in chance.items() if p >= 0.5])
    # The drawn keys are at most 2 * DRAWN_ROWS: a side of known size.
    keys = docs.sparkSession.createDataFrame(sorted(drawn), "long").withColumnRenamed("value", "key_")
    found = featured(keyed.join(F.broadcast(keys), F.col("key") == F.col("key_")).select(F.col("key").alias("id"), "text"))
    known = sorted(found)
    goal = np.array([chance[drawn[k]] for k in known])
    stands_for = np.ones(len(known))
    for side in (True, False):
        here = (goal >= 0.5) == side
        stands_for[here] = there[side] / max(here.sum(), 1)
    # Weights of mean one: the penalty means the same in a corpus of any size.
    model = train_linear([found[k][0] for k in known], goal, stands_for / max(stands_for.mean() if len(known) else 1, 1e-12))
    del found
    pa.default_memory_pool().release_unused()
    return model


def keeper(model: Linear) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole rows of the texts that the model does not hold toxic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in batch.column("text")]
            yield batch.filter(pa.array(model.score(texts) < TOXIC))

    return run


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not hold toxic, with all their columns."""
    return docs.mapInArrow(frees_memory(keeper(fit_toxicity(docs, labels))), docs.schema)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels)
    return scores(docs, model.score).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"))
