"""Text operators against their plain SQL, on tables that hold links, repeats and odd rows."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfline.llm.embeddings import near_vectors  # noqa: E402
from shelfline.llm.registry import llm_oracles, llm_queries  # noqa: E402


def near(draw, unit, cosine):
    """A vector at the given cosine to a unit vector."""
    other = draw.standard_normal(len(unit))
    other -= (other @ unit) * unit
    return cosine * unit + np.sqrt(1 - cosine ** 2) * other / np.linalg.norm(other)


def unit_vector(draw, size):
    vector = draw.standard_normal(size)
    return vector / np.linalg.norm(vector)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw, rng = np.random.default_rng(8), random.Random(8)
    vectors = []
    for label in (0, 1):
        for _ in range(25):
            unit = unit_vector(draw, 32)
            vectors += [(unit, label)] + [(near(draw, unit, c) * 3, label) for c in draw.uniform(0.9, 0.999, rng.randrange(5))]
        vectors += [(unit, 1 - label), (unit, None), (unit, label), (unit[:8], label), (unit * 0, label)]
    rows = [(n, [float(x) for x in v], label) for n, (v, label) in enumerate(vectors)]
    rows += [(900, None, 1), (901, [1.0, None], 1), (902, [float("nan"), 1.0], 1), (903, [float("inf"), 1.0], 0), (904, [], 0)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")

    word = lambda: "".join(rng.choice("aeilnorstÄé") for _ in range(rng.randint(1, 6)))
    vocabulary = [word() for _ in range(300)]
    passage = [" ".join(rng.choices(vocabulary, k=150)) for _ in range(3)]
    texts = []
    for n in range(40):
        words = rng.choices(vocabulary, k=rng.randrange(5, 200))
        texts.append(" ".join(words))
        for _ in range(rng.randrange(3)):
            changed = list(words)
            for _ in range(rng.randrange(1 + len(words) // 12)):
                changed[rng.randrange(len(changed))] = "Edited"
            texts.append(("\n" if n % 2 else "  ").join(changed).upper() if n % 7 == 0 else " ".join(changed))
        if n % 4 == 0:
            texts.append(" ".join([words[0], passage[n % 3], words[-1], passage[n % 3][:700]]))
        texts.append(" ".join(words[:3] * rng.randrange(1, 6) + words[3:9] + words[4:9] * 4))
    texts += [None, "", " \t\n", "one", "two Words", "Two words", "ab" * 3000, "x " * 900, "x " * 900]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.mark.parametrize("name, found", [
    ("op2_embeddings", "n_links > 0 AND NOT kept"), ("op10_minhash", "NOT kept AND n_shingles > 20"),
    ("op11_suffixes", "n_removed > 0"), ("op13_periods", "n_runs > 1")])
def test_query_agrees_with_its_sql(spark, folder, name, found):
    got = llm_queries()[name](spark, folder)
    tables = duckdb.connect()
    for table in ("documents", "embeddings"):
        tables.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet/*.parquet'")
    want = tables.sql(llm_oracles()[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(map(tuple, got.select(*want.columns).collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr)
    assert len(want.filter(found).fetchall()) > 10


def test_recall_just_above_the_threshold(spark):
    """800 pairs of 64 components at a cosine of 0.93 to 0.94: at most one in 100 is missed."""
    draw = np.random.default_rng(3)
    rows = []
    for n in range(800):
        unit = unit_vector(draw, 64)
        rows += [(2 * n, unit.tolist(), 1), (2 * n + 1, near(draw, unit, draw.uniform(0.9301, 0.94)).tolist(), 1)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    linked = got.where("n_links = 1 AND component_id = vec_id - vec_id % 2").count()
    assert linked >= 2 * 792
    assert got.where("n_links > 1").count() == 0
