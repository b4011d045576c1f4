"""Quality classifier: a small convolutional network over bytes, in numpy.

Bytes are embedded; filters look at chunks of 16 bytes that start every 8 bytes and
so cover the whole text twice; each filter's largest response over the text is kept,
and a logistic layer combines them into one probability. The network is trained on
the driver from the whole texts of a bounded sample of labelled rows; texts of any
length are trained on and scored whole, in pieces of fixed size.

Defined cases: null and empty texts score like a text without chunks; documents
without a label are scored like others; repeated rows get equal scores; labels
without a document are ignored; without any labels of both kinds the score is the
share of good labels (0.5 without labels); extra columns do no harm; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import in_small_batches, table
from shelfline.llm.samples import fold, labelled_sample

SAMPLE_ROWS = 3000
FOLDS, HELD_OUT = 4, 2
GOOD = 0.7
STEP = 8
WIDTH = 8
FILTERS = 32
PIECE = 1 << 19
ROWS = 500
EPOCHS = 8
BATCH = 50


@dataclass
class Network:
    codes: np.ndarray    # 256 x WIDTH: a vector per byte
    filters: np.ndarray  # 2 x STEP * WIDTH x FILTERS: for the two halves of a chunk
    shift: np.ndarray    # FILTERS
    weights: np.ndarray  # FILTERS
    bias: np.ndarray     # 1

    def parts(self) -> list[np.ndarray]:
        return [self.codes, self.filters, self.shift, self.weights, self.bias]

    def responses(self, blocks: np.ndarray) -> np.ndarray:
        """Of each chunk, two neighbouring rows of bytes, to each filter."""
        rows = self.codes[blocks].reshape(len(blocks), -1)
        return rows[:-1] @ self.filters[0] + rows[1:] @ self.filters[1] + self.shift

    def peaks(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chunk, value) of each filter's first largest response over the rows of a text; long texts go piece by piece."""
        at, most, rows = np.zeros(FILTERS, int), np.full(FILTERS, -np.inf, np.float32), PIECE // STEP
        for start in range(0, len(blocks) - 1, rows):
            # Neighbouring pieces share a row, so that every chunk is in one piece.
            found = self.responses(blocks[start:start + rows + 1])
            here = found.argmax(axis=0)
            value = found[here, np.arange(FILTERS)]
            at, most = np.where(value > most, here + start, at), np.maximum(most, value)
        return at, most

    def pooled(self, text: bytes) -> np.ndarray:
        """The filters' largest responses over a whole text, at least 0."""
        return np.maximum(self.peaks(in_blocks(text))[1], 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """One probability per text; short texts share a pass over their blocks."""
        most = np.zeros((len(texts), FILTERS), np.float32)
        for group in passes(texts):
            if len(group) == 1:
                most[group[0]] = self.pooled(texts[group[0]])
                continue
            blocks = [in_blocks(texts[n]) for n in group]
            ends = np.cumsum([len(b) for b in blocks])
            found = self.responses(np.concatenate(blocks))
            found[ends[:-1] - 1] = 0  # these chunks would span two texts
            most[group] = np.maximum(np.maximum.reduceat(found, np.concatenate(([0], ends[:-1])), axis=0), 0)
        return sigmoid(most @ self.weights + self.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -30, 30)))


def in_blocks(text: bytes) -> np.ndarray:
    """Rows of STEP bytes, padded with zeros, and one row of zeros."""
    rows = -(-len(text) // STEP) + 1
    return np.frombuffer(text.ljust(rows * STEP, b"\0"), np.uint8).reshape(rows, STEP)


def passes(texts: list[bytes]) -> Iterator[list[int]]:
    """Numbers of neighbouring non-empty texts of about PIECE bytes together; a longer one is alone."""
    group, size = [], 0
    for n, text in enumerate(texts):
        if not text:
            continue
        if group and size + len(text) > PIECE:
            yield group
            group, size = [], 0
        group.append(n)
        size += len(text)
    if group:
        yield group


def train(sample: list[tuple[str, int]], seed: int = 5) -> Network:
    """Fit by Adam on the logistic loss; the gradient of a maximum goes to the chunk that gave it."""
    draw = np.random.default_rng(seed)
    net = Network(draw.normal(0, 0.5, (256, WIDTH)).astype(np.float32),
                  draw.normal(0, 0.1, (2, STEP * WIDTH, FILTERS)).astype(np.float32),
                  np.zeros(FILTERS, np.float32), draw.normal(0, 0.1, FILTERS).astype(np.float32), np.zeros(1, np.float32))
    blocks = [in_blocks(text.encode()) for text, _ in sample]
    goal = np.array([label for _, label in sample], np.float32)
    share = float(goal.mean()) if len(goal) else 0.5
    if share in (0.0, 1.0) or not len(goal):
        net.weights[:] = 0
        net.bias[:] = np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -4, 4)
        return net
    net.bias[:] = np.log(share / (1 - share))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(sample))
        for n in range(0, len(order), BATCH):
            grads = [np.zeros_like(p) for p in net.parts()]
            picked = order[n:n + BATCH]
            for k in picked:
                gradient(net, blocks[k], goal[k], grads)
            step += 1
            rate = 0.004 * (1 - epoch / EPOCHS) + 0.0004
            for p, g, (m, v) in zip(net.parts(), grads, moments, strict=True):
                g /= len(picked)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def gradient(net: Network, blocks: np.ndarray, goal: float, grads: list[np.ndarray]) -> None:
    if len(blocks) < 2:
        grads[4] += sigmoid(net.bias).astype(np.float32) - goal
        return
    at, most = net.peaks(blocks)
    most = np.maximum(most, 0)
    error = float(sigmoid(most @ net.weights + net.bias)[0]) - goal
    grads[3] += error * most + 1e-4 * net.weights
    grads[4] += error
    back = np.where(most > 0, error * net.weights, 0).astype(np.float32)
    grads[2] += back
    for half in range(2):
        bytes_ = blocks[at + half]
        grads[1][half] += net.codes[bytes_].reshape(FILTERS, -1).T * back
        np.add.at(grads[0], bytes_.ravel(), (net.filters[half].T * back[:, None]).reshape(-1, WIDTH))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, whose texts may be copied."""
    for batch in batches:
        for n in range(0, batch.num_rows, ROWS):
            yield batch.slice(n, ROWS)


def scorer(score: Callable[[list[bytes]], np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The other columns and a score per row of batches with a text column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in batch.column("text")]
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(score(texts), pa.float64())], names=[*rest.schema.names, "score"])

    return run


def scores(docs: DataFrame, score: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """doc_id and the score of every row's whole text."""
    return in_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(scorer(score), "doc_id long, score double")


def fit_quality(docs: DataFrame, labels: DataFrame) -> Network:
    return train(labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, SAMPLE_ROWS))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = fit_quality(docs, labels)
    return scores(docs, net.score).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"))
