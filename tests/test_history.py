from __future__ import annotations

import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from shelfline.operators.history import key_bounds, scd2_merge

SCHEMA = ("item int, name string, created_dttm timestamp, valid_from_dttm timestamp, valid_to_dttm timestamp,"
          "updated_dttm timestamp, is_actual string, load_dttm timestamp")
OPEN = dt.datetime(2999, 12, 31)
AS_OF = dt.datetime(2030, 1, 1)


def at(day, second=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, seconds=second)


def version(item, name, start, end, actual):
    return (item, name, start, start, end, start, actual, start)


def merge(spark, target, increment):
    merged = scd2_merge(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(increment, SCHEMA),
                        "item", F.lit(AS_OF))
    return rows(merged, "item", "name", "valid_from_dttm", "valid_to_dttm", "is_actual", "updated_dttm")


def test_bounds_of_new_versions(spark):
    df = spark.createDataFrame([version(1, "a", at(1), at(2), "0"), version(1, "b", at(2, 1), OPEN, "1")], SCHEMA)
    assert rows(key_bounds(df, "item")) == [(1, at(1), OPEN)]


def test_every_branch(spark):
    target = [
        version(1, "open", at(0), OPEN, "1"), version(1, "closed", at(-9), at(-1), "0"),
        version(2, "untouched", at(0), OPEN, "1"), version(2, "untouched old", at(-5), at(-1), "0"),
    ]
    increment = [version(1, "new", at(10), OPEN, "1"), version(3, "first", at(10), OPEN, "1")]
    assert merge(spark, target, increment) == sorted([
        (1, "new", at(10), OPEN, "1", at(10)),
        (1, "open", at(0), at(10, -1), "0", AS_OF),
        (1, "closed", at(-9), at(-1), "0", at(-9)),
        (2, "untouched", at(0), OPEN, "1", at(0)),
        (2, "untouched old", at(-5), at(-1), "0", at(-5)),
        (3, "first", at(10), OPEN, "1", at(10)),
    ], key=repr)


def test_version_starting_with_the_increment_is_replaced(spark):
    target = [version(1, "same start", at(10), OPEN, "1")]
    increment = [version(1, "new", at(10), OPEN, "1")]
    assert merge(spark, target, increment) == [(1, "new", at(10), OPEN, "1", at(10))]


def test_version_inside_a_closed_increment_moves_behind_it(spark):
    target = [version(1, "late", at(12), OPEN, "1")]
    increment = [version(1, "new", at(10), at(20), "0")]
    assert merge(spark, target, increment) == [
        (1, "late", at(20, 1), OPEN, "0", AS_OF), (1, "new", at(10), at(20), "0", at(10))]


def test_chains_stay_free_of_overlap(spark):
    rng = random.Random(3)
    target, increment = [], []
    for item in range(30):
        starts = sorted(rng.sample(range(100), rng.randrange(1, 6)))
        ends = [at(s, -1) for s in starts[1:]] + [OPEN]
        chain = [version(item, f"v{s}", at(s), e, "1" if e == OPEN else "0") for s, e in zip(starts, ends)]
        cut = rng.randrange(len(chain) + 1)
        old, new = chain[:cut], chain[cut:]
        if old:
            last = list(old[-1])
            last[4], last[6] = OPEN, "1"
            old[-1] = tuple(last)
        target, increment = target + old, increment + new
    got = merge(spark, target, increment)
    for item in range(30):
        chain = sorted((r for r in got if r[0] == item), key=lambda r: r[2])
        assert sum(r[4] == "1" for r in chain) == 1
        assert all(a[3] < b[2] for a, b in zip(chain, chain[1:]))
