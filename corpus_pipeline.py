"""The corpus pipeline: filter, deduplicate, mix and encode documents, stage by stage.

Every stage but the last returns the columns of documents. A stage sees only what its
predecessor kept; near duplicates are therefore judged on texts that have already lost
their repeated runs of lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm.common import table
from shelfline.llm.lines import dedupe
from shelfline.llm.mixing import mix
from shelfline.llm.neardups import keep_one
from shelfline.llm.pieces import encode_documents
from shelfline.llm.toxicity import reject_toxic
from shelfline.session import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity classifier rejects."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later repeats of runs of lines; documents left empty by it go."""
    return dedupe(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out documents so that the sources come near their target weights."""
    return mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that the mix emits."""
    return encode_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near-dedup", without_near_duplicates),
    ("mixing", mixed),
    ("pieces", encoded),
]

# The label model, the network of links and the merges have no SQL form; the stages
# are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read back before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
