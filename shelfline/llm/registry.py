"""The queries of this package and their DuckDB forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import (
    embeddings, fingerprints, licenses, lines, mixing, neardups, oracles, periods, pieces, quality, sharding, suffixes, toxicity, tries)

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_embeddings": embeddings.op2_embeddings,
        "op3_lines": lines.op3_lines,
        "op4_fingerprints": fingerprints.op4_fingerprints,
        "op5_quality": quality.op5_quality,
        "op6_sharding": sharding.op6_sharding,
        "op7_pieces": pieces.op7_pieces,
        "op8_licenses": licenses.op8_licenses,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_minhash": neardups.op10_minhash,
        "op11_suffixes": suffixes.op11_suffixes,
        "op12_tries": tries.op12_tries,
        "op13_periods": periods.op13_periods,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op1_mixing": mixing.OP1_SQL,
        "op2_embeddings": oracles.OP2_SQL,
        "op10_minhash": oracles.OP10_SQL,
        "op11_suffixes": oracles.OP11_SQL,
        "op12_tries": tries.OP12_SQL,
        "op13_periods": oracles.OP13_SQL,
    }
