"""Features and level means are joined where the rows lie, with the rows of plain joins."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline.operators import aggregates as agg
from shelfline.operators import features as feat
from shelfline.operators import hierarchy as hier
from shelfline.operators import keyed

MEASURES = feat.measures_of("qty_scaled", "price", shorten=("qty_scaled",))
REACH = feat.Reach(3, 4, 2, 5)


@pytest.fixture(scope="module")
def odd_weeks(spark):
    """Keys with several rows in some weeks, rows without a week and rows without a key."""
    rng = random.Random(9)
    data = [(100 + n // 52, n % 52, n, i, float(rng.randrange(9)), rng.choice([None, 1.0, 2.5]))
            for i in (1, 2, 3, 4, None) for n in range(5, 130) if rng.random() < .6 for _ in range(rng.choice([1, 1, 2]) if i != 1 else 1)]
    data += [(None, None, None, i, 3.0, 1.0) for i in (3, 3, None)]
    return spark.createDataFrame(data, "year int, week int, week_num int, item int, qty_scaled double, price double")


def combined(spark, weekly, spread):
    calendar = spark.createDataFrame([(n, n - (52 if n % 3 else 50)) for n in range(120)], "week_num int, prev_week_num int")
    week = feat.offset_features(weekly, ["item"], MEASURES, REACH, spread=spread)
    year = feat.prior_year_features(weekly, calendar, ["item"], MEASURES, REACH, spread=spread)
    return feat.combine_features(week, year, ["item"], *([] if spread else [MEASURES, REACH]))


def test_combined_timelines_are_the_combined_rows(spark, odd_weeks):
    got, want = combined(spark, odd_weeks, False), combined(spark, odd_weeks, True)
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    assert got.count() > odd_weeks.count()


def test_combined_timelines_meet_where_they_lie(spark, odd_weeks):
    """One shuffle of the weeks and none of features, also where Spark wants all keys of a join laid out."""
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "true", "spark.sql.adaptive.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = combined(spark, odd_weeks.repartition(3, "item"), False)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("- Exchange hashpartitioning") == 1 == plan.count("- ReusedExchange")
        assert found.rdd.getNumPartitions() == 3
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.fixture
def level_rows(spark):
    weekly = spark.createDataFrame(
        [(1, w and w % 50, w, i, key, model, 1.0) for w in (3, 4, 9, 40, None) for i, key, model in [
            (1, "1|2|A", "-1"), (2, "1|2|B", "7"), (3, "1|3|A", None), (4, None, None), (None, "9|9|9", "7")]],
        "year int, week int, week_num int, item int, dept_class_subclass string, model string, q double")
    def means(level, data):
        name, _ = hier.LEVELS[level]
        return spark.createDataFrame(data, f"week_num int, {name} string, avg_item_qty_by_{level}_scaled double")

    return weekly, [
        means("class", [(3, "1|2", 0.5), (9, "1|2", None), (40, "1|2", 0.25), (4, None, 9.0), (None, "1|2", 8.0), (4, "1|3", 1.0)]),
        means("subclass", [(4, "1|2|A", 0.125), (9, "1|2|A", 0.75), (39, "1|2|B", 1.0), (41, "1|2|B", 1.0)]),
        means("model", [(w, m, w / 64) for w in (3, 4, 40) for m in ("-1", "7")])]


def test_lines_of_level_means_give_the_rows_of_a_join(spark, level_rows, monkeypatch):
    weekly, means = level_rows
    want = rows(hier.attach_level_averages(weekly, *means))
    monkeypatch.setattr(keyed, "within_broadcast", lambda df: False)
    lines = [hier.level_lines(side, level) for level, side in zip(hier.LEVELS, means)]
    assert all("_line" in side.columns and hier.joined_in_place(side) for side in lines)
    got = hier.attach_level_averages(weekly.repartition(3, "item"), *lines)
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == want and got.rdd.getNumPartitions() == 3
    # What is too large, or has two rows in a week, stays as it is and is joined by key.
    twice = means[1].union(means[1].limit(1))
    assert hier.level_lines(twice, "subclass") is twice
    monkeypatch.setattr(hier, "MOST_LINE_WEEKS", 1)
    assert [hier.level_lines(side, level) for level, side in zip(hier.LEVELS, means)] == means
    assert rows(hier.attach_level_averages(weekly, *means)) == want


@pytest.fixture
def lines(spark):
    """Ticket lines, a third of them of one item and a few without store or item, in six parts."""
    rng = random.Random(3)
    data = [(rng.choice([0, 1, 2, 3, None]), rng.choice([7, *range(100, 102), rng.randrange(200, 260), None]),
             dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(60)), float(rng.randrange(1, 9)), float(rng.randrange(99))) for _ in range(900)]
    return spark.createDataFrame(data, "store int, item bigint, sell_date date, item_qty_raw double, total_cost double").withColumn(
        "item_qty_processed", F.col("item_qty_raw")).repartition(6)


def test_store_weeks_take_one_shuffle_of_the_lines(spark, lines, monkeypatch):
    dates = spark.createDataFrame(
        [(7, 6, dt.date(2024, 2, 9)), (101, 6, dt.date(2024, 1, 20)), (102, 7, dt.date(2024, 1, 1)), (None, 6, dt.date(2024, 1, 1))],
        "item bigint, uda_id int, uda_date date")
    attributes = spark.createDataFrame(
        [(n, f"1|{(n or 0) % 3}|A", str((n or 0) % 5)) for n in [7, 7, *range(100, 250), None]], "item bigint, dept_class_subclass string, model string")
    want = rows(hier.agg_tickets_by_store(agg.agg_day_store_item(lines), dates, attributes))
    monkeypatch.setattr(keyed, "within_broadcast", lambda df: False)
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "true", "spark.sql.adaptive.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        daily = agg.agg_day_store_item(keyed.dealt_by(lines, ["item"], ["store"], 5, lines.select("item")))
        # Items with over a thousandth of the lines are dealt by store as well.
        assert daily.where("item = 7").select(keyed.DEAL).distinct().count() == daily.where("item = 7").select("store").distinct().count()
        found = hier.agg_tickets_by_store(daily, dates, attributes, counted=lines.select("item"))
        assert rows(found) == want and found.rdd.getNumPartitions() == 5
        plan = found._jdf.queryExecution().executedPlan().toString()
        # The lines, and by item the two lookups and the count.
        assert plan.count("- Exchange hashpartitioning(store") == plan.count("- Exchange hashpartitioning(year") == 0
        assert len(re.findall(r"- Exchange hashpartitioning\(item#\d+L?, _deal#\d+, 5\), REPARTITION_BY_NUM", plan)) == 1
        alone = agg.agg_day_store_item(lines).repartition(5, "item")
        found = hier.agg_tickets_by_store(alone, dates, attributes.repartition(8, "item"), tasks=5)
        assert rows(found) == want and found.rdd.getNumPartitions() == 5
        assert found._jdf.queryExecution().executedPlan().toString().count("- Exchange hashpartitioning(year") == 0
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lines_meet_their_caps_where_they_are_added_up(spark, lines, monkeypatch):
    tickets = lines.select("store", "item", "sell_date", F.col("item_qty_raw").alias("item_qty"), "total_cost")
    caps = spark.createDataFrame([(7, 3.0), (100, 2.0), (None, 1.0)], "item bigint, item_qty_max_offline double")
    want = rows(agg.agg_day_store_item(agg.cap_quantities(tickets, caps)))
    monkeypatch.setattr(keyed, "within_broadcast", lambda df: False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = tickets.select("item")
        capped = agg.cap_quantities(keyed.dealt_by(tickets, ["item"], ["store"], 5, items), caps, counted=items)
        days = agg.agg_day_store_item(capped).drop(keyed.DEAL)
        plan = days._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(sell_date" not in plan and "hashpartitioning(store" not in plan
        assert rows(days) == want and days.rdd.getNumPartitions() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wide_features_are_not_compiled_into_one_method(spark, odd_weeks):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = feat.offset_features(odd_weeks, ["item"], MEASURES, REACH)
        # A star marks what Spark compiles as a whole.
        top = found._jdf.queryExecution().executedPlan().toString().split("\n")[0]
        assert top.startswith("Project") and "price_next_w4" in top
        assert found.dtypes[:3] == odd_weeks.dtypes[:3]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_values_are_rounded_once_per_week(spark, odd_weeks):
    weekly = odd_weeks.withColumns({"qty_scaled": F.col("qty_scaled") / 7, "price": F.col("price") / 3})
    calendar = spark.createDataFrame([(n, n - 52) for n in range(130)], "week_num int, prev_week_num int")
    exceptions = spark.createDataFrame([(101, 80, 132)], "year int, week_num int, next_week_num int")
    plain = feat.masked_features(weekly, calendar, exceptions, ["item"], MEASURES, REACH)
    got = feat.masked_features(weekly, calendar, exceptions, ["item"], MEASURES, REACH, 2)
    want = plain.select(*[F.round(c, 2).alias(c) if t == "double" else c for c, t in plain.dtypes])
    assert got.dtypes == want.dtypes and rows(got) == rows(want) != rows(plain)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("round(") < 30
