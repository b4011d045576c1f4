from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.compare import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "merge_increment", "scd2_merge", "reconcile_partitions", "outlier_caps", "densify_prices", "asof_past",
    "asof_future", "avg_scaled_with_stock", "features_by_week", "features_v2_masked", "shred_products",
]


def test_flagship_has_rows(spark):
    df = entry(spark)
    assert df.count() > 0 and "item_qty_prev_w6" in df.columns


def test_table_queries_have_an_oracle():
    """Of the table queries; the text operators have tests of their own."""
    tables = {name for name in queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert tables <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_agrees_with_its_oracle(spark, name):
    result = compare(spark, connect(FOLDER), FOLDER, name, oracle_sql()[name])
    assert result.startswith("ok"), result
