from __future__ import annotations

import random

import pytest
from conftest import rows

from shelfline.operators import features as feat

MEASURES = feat.measures_of("qty_scaled", "price", shorten=("qty_scaled",))
REACH = feat.Reach(3, 4, 2, 5)
SCHEMA = "year int, week int, week_num int, item int, qty_scaled double, price double"


@pytest.fixture(scope="module")
def weekly(spark):
    rng = random.Random(1)
    data = [(100 + n // 52, n % 52, n, i, float(rng.randrange(9)), float(rng.randrange(5)) if rng.random() < .8 else None)
            for i in range(3) for n in range(5, 150) if rng.random() < .6]
    return data, spark.createDataFrame(data, SCHEMA)


def test_names_follow_the_marts():
    week, year = feat.week_offsets(1, 1), feat.year_offsets(1, 1)
    assert [s for s, _ in week] == ["prev_w1", "next_w1"] and [s for s, _ in year] == ["y", "yw1", "next_yw1"]
    assert MEASURES[0].week == "qty" and MEASURES[0].year == "qty_scaled"
    assert len(feat.week_offsets(8, 10)) * 5 == 90 and len(feat.year_offsets(12, 12)) * 5 == 125


def test_offsets_agree_with_lookup(weekly):
    data, df = weekly
    at = {(r[3], r[2]): r for r in data}
    for r in feat.offset_features(df, ["item"], MEASURES, REACH).collect():
        for suffix, d in feat.week_offsets(REACH.left, REACH.right):
            other = at.get((r.item, r.week_num + d))
            assert r[f"qty_{suffix}"] == (other and other[4])
            assert r[f"price_{suffix}"] == (other and other[5])


def test_prior_year_agrees_with_lookup(spark, weekly):
    data, df = weekly
    matches = {n: n - (52 if n % 3 else 50) for n in range(200)}
    calendar = spark.createDataFrame(list(matches.items()), "week_num int, prev_week_num int")
    got = feat.prior_year_features(df, calendar, ["item"], MEASURES, REACH).collect()
    at = {(r[3], r[2]): r for r in data}
    expected = {
        (r[3], r[2]) for r in data
        if any((r[3], matches[r[2]] + d) in at for d in range(-REACH.year_left, REACH.year_right + 1))}
    assert {(r.item, r.week_num) for r in got} == expected and len(got) == len(expected)
    for r in got:
        for suffix, d in feat.year_offsets(REACH.year_left, REACH.year_right):
            other = at.get((r.item, matches[r.week_num] + d))
            assert r[f"qty_scaled_{suffix}"] == (other and other[4])


def test_calendar_moves_back_by_the_weeks_on_record(spark):
    df = spark.createDataFrame([(2018, w, 2505 + w) for w in range(10, 53)] + [(2019, 1, 2558)], "year int, week int, week_num int")
    got = {r.week_num: r.prev_week_num for r in feat.week_calendar(df).collect()}
    # 2018-12-31 lies in week 2557, the first week on record is 2515: 43 weeks.
    assert got[2515] == 2515 - 43 and got[2558] == 2558 - (2609 - 2558 + 1)


def masked_brute(week, year, exceptions, distance, prior):
    """Whether a feature is hidden, straight from the rule for spans."""
    weeks = [(nxt if prior else w) for y, w, nxt in exceptions if (y + 1 if prior else y) == year]
    left, right = (REACH.year_left, REACH.year_right) if prior else (REACH.left, REACH.right)
    if distance < 0 or (prior and distance == 0):
        p1 = min((w for w in weeks if w + left >= week), default=None)
        p2 = max((w for w in weeks if w <= week), default=0)
        return p1 is not None and week - p2 <= -distance <= week - p1
    n1 = max((w for w in weeks if w - right <= week), default=None)
    n2 = min((w for w in weeks if w >= week), default=0)
    return n1 is not None and n2 - week <= distance <= n1 - week


@pytest.mark.parametrize("exceptions", [
    [], [(101, 80, 132)], [(101, 79, 131), (101, 82, 134)], [(100, 50, 102), (101, 53, 104), (101, 60, 113), (102, 110, 160)],
    [(101, 70, 122), (101, 73, 125), (101, 74, 126), (102, 123, 175)],
])
def test_masking_agrees_with_the_rule(spark, exceptions):
    columns = [f"{m.week}_{s}" for s, _ in feat.week_offsets(REACH.left, REACH.right) for m in MEASURES]
    columns += [f"{m.year}_{s}" for s, _ in feat.year_offsets(REACH.year_left, REACH.year_right) for m in MEASURES]
    data = [(100 + n // 52, n % 52, n, 1, 1.0, 1.0, *[1.0] * len(columns)) for n in range(40, 150)]
    df = spark.createDataFrame(data, SCHEMA + "".join(f", {c} double" for c in columns))
    listed = spark.createDataFrame(exceptions, "year int, week_num int, next_week_num int")
    got = feat.mask_exceptions(df, listed, MEASURES, REACH)
    assert got.columns == df.columns
    result = got.collect()
    assert sorted(r.week_num for r in result) == [n for n in range(40, 150) if n not in {e[1] for e in exceptions}]
    for r in result:
        for suffix, d in feat.week_offsets(REACH.left, REACH.right):
            assert (r[f"qty_{suffix}"] is None) == masked_brute(r.week_num, r.year, exceptions, d, False), (r.week_num, suffix)
        for suffix, d in feat.year_offsets(REACH.year_left, REACH.year_right):
            assert (r[f"price_{suffix}"] is None) == masked_brute(r.week_num, r.year, exceptions, d, True), (r.week_num, suffix)


def test_combine_keeps_rows_without_a_prior_year(spark):
    week = spark.createDataFrame([(1, 1, 1, 7, 2.0), (1, 2, 2, 7, 3.0)], "year int, week int, week_num int, item int, a double")
    year = spark.createDataFrame([(1, 2, 2, 7, 9.0)], "year int, week int, week_num int, item int, b double")
    assert rows(feat.combine_features(week, year, ["item"])) == [(1, 1, 1, 7, 2.0, None), (1, 2, 2, 7, 3.0, 9.0)]


def test_rollup_adds_quantities_and_averages_prices(spark):
    df = spark.createDataFrame([(1, 1, 1, s, 7, float(s), 2.0 * s, 1.0, None) for s in (1, 3)],
                               "year int, week int, week_num int, store int, item int, item_qty double,"
                               "avg_purchase_price double, item_qty_prev_w1 double, avg_purchase_price_y double")
    assert rows(feat.rollup_over_stores(df, feat.BASIC)) == [(1, 1, 1, 7, 4.0, 4.0, 2.0, None)]


@pytest.fixture(scope="module")
def repeated(spark):
    """Keys with several rows in some weeks."""
    rng = random.Random(4)
    data = [(100 + n // 52, n % 52, n, i, float(rng.randrange(9)), float(rng.randrange(5)) if rng.random() < .8 else None)
            for i in range(4) for n in range(5, 150) if rng.random() < .6 for _ in range(rng.choice([1, 1, 1, 2, 3]) if i else 1)]
    return data, spark.createDataFrame(data, SCHEMA)


def added(data, item, week, column):
    found = [r[column] for r in data if r[3] == item and r[2] == week and r[column] is not None]
    return sum(found) if found else None


def test_rows_of_a_repeated_week_add_up(spark, repeated):
    data, df = repeated
    matches = {n: n - (52 if n % 3 else 50) for n in range(200)}
    calendar = spark.createDataFrame(list(matches.items()), "week_num int, prev_week_num int")
    got = feat.week_and_year_features(df, calendar, ["item"], MEASURES, REACH).collect()
    assert len(got) == len(data)
    for r in got:
        for suffix, d in feat.week_offsets(REACH.left, REACH.right):
            assert r[f"qty_{suffix}"] == added(data, r.item, r.week_num + d, 4)
            assert r[f"price_{suffix}"] == added(data, r.item, r.week_num + d, 5)
        for suffix, d in feat.year_offsets(REACH.year_left, REACH.year_right):
            assert r[f"qty_scaled_{suffix}"] == added(data, r.item, matches[r.week_num] + d, 4)
    alone = feat.prior_year_features(df, calendar, ["item"], MEASURES, REACH).collect()
    reach = range(-REACH.year_left, REACH.year_right + 1)
    weeks = {(r[3], r[2]) for r in data}
    assert len(alone) == sum(any((r[3], matches[r[2]] + d) in weeks for d in reach) for r in data)


@pytest.mark.parametrize("exceptions", [[], [(101, 79, 131), (101, 82, 134)], [(100, 50, 102), (101, 53, 104), (102, 110, 160)]])
def test_masked_slices_agree_with_masked_columns(spark, repeated, exceptions):
    _, df = repeated
    calendar = spark.createDataFrame([(n, n - 52) for n in range(0, 200)], "week_num int, prev_week_num int")
    listed = spark.createDataFrame(exceptions, "year int, week_num int, next_week_num int")
    wide = feat.mask_exceptions(feat.week_and_year_features(df, calendar, ["item"], MEASURES, REACH), listed, MEASURES, REACH)
    got = feat.masked_features(df, calendar, listed, ["item"], MEASURES, REACH)
    assert got.columns == wide.columns and rows(got) == rows(wide)


def test_week_and_year_features_take_one_shuffle_and_no_wide_join(spark, weekly):
    _, df = weekly
    calendar = spark.createDataFrame([(n, n - 52) for n in range(200)], "week_num int, prev_week_num int")
    both = feat.week_and_year_features(df, calendar, ["item"], MEASURES, REACH)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "Window [" not in plan
    apart = feat.combine_features(
        feat.offset_features(df, ["item"], MEASURES, REACH),
        feat.prior_year_features(df, calendar, ["item"], MEASURES, REACH), ["item"])
    assert both.columns == apart.columns and rows(both) == rows(apart)
