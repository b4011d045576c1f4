from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows

from shelfline.operators import aggregates as agg

D = dt.date


def test_outlier_caps_follow_the_busier_channel(spark):
    offline = {1: [1.0] * 10 + [100.0], 2: [5.0, 6.0], 3: [1.0], 5: list(map(float, range(1, 21)))}
    online = {1: [2.0], 2: [9.0] * 3, 3: [3.0] * 10 + [30.0], 4: [7.0], 5: list(map(float, range(1, 12)))}

    def lines(groups):
        return spark.createDataFrame([(i, q) for i, qs in groups.items() for q in qs], "item int, item_qty double")

    got = {r.item: (r.item_qty_max_offline, r.item_qty_max_online)
           for r in agg.outlier_caps(lines(offline), lines(online)).collect()}
    high = 1.0 + 0.5 * 99.0  # between the tenth and eleventh of eleven values
    assert got[1] == pytest.approx((high * 1.5, high * 1.5))
    assert got[2] == (9.0, 9.0)
    assert got[3] == pytest.approx((3.0 + 0.5 * 27, 3.0 + 0.5 * 27))
    assert got[4] == (7.0, 7.0)
    assert got[5] == pytest.approx((19.05 * 1.5, 10.5))


def test_capped_quantity(spark):
    tickets = spark.createDataFrame([(1, 5.0), (1, 50.0), (2, 9.0)], "item int, item_qty double")
    caps = spark.createDataFrame([(1, 8.0)], "item int, item_qty_max_offline double")
    got = agg.cap_quantities(tickets, caps)
    assert rows(got) == [(1, 5.0, 5.0, 5.0), (1, 50.0, 50.0, 8.0), (2, 9.0, 9.0, 9.0)]


def test_day_sales_skip_deliveries_and_split_on_demand(spark):
    day = D(2024, 1, 2)
    tickets = spark.createDataFrame(
        [(day, 1, 10, 9.0, 2.0, 2.0), (day, 1, 10, 8.0, 2.0, 1.0), (day, 1, 10, 5.0, 1.0, 1.0),
         (day, 1, 4900, 1.0, 1.0, 1.0), (day, 9, 10, 1.0, 1.0, 1.0), (day, 1, 11, 3.0, 0.0, 0.0)],
        "sell_date date, store int, item int, total_cost double, item_qty_raw double, item_qty_processed double")
    whole = agg.agg_day_store_item(tickets, stores=[1])
    assert rows(whole) == [(day, 1, 10, 3, 22.0, 4.0, 4.0), (day, 1, 11, 1, 3.0, 0.0, None)]
    split = agg.agg_day_store_item(tickets.where("item = 10 AND store = 1"), split_by_raw_qty=True)
    assert rows(split) == [(day, 1, 10, 1, 5.0, 1.0, 5.0), (day, 1, 10, 2, 17.0, 3.0, 4.0)]


def test_first_sale_date(spark):
    schema = "item int, sell_date date"
    a = spark.createDataFrame([(1, D(2024, 1, 5)), (1, D(2024, 1, 3)), (2, D(1970, 1, 1)), (0, D(2024, 1, 1))], schema)
    b = spark.createDataFrame([(1, D(2024, 1, 4)), (3, D(2023, 1, 1)), (4, None)], schema)
    got = agg.first_sale_date([a, b], sentinel=D(1970, 1, 1))
    assert rows(got) == [(1, D(2024, 1, 3)), (2, D(2040, 1, 1)), (3, D(2023, 1, 1)), (4, D(2040, 1, 1))]


def test_stock_flags_count_negative_stock_as_empty(spark):
    day = D(2024, 1, 2)
    stock = spark.createDataFrame(
        [(1, 7, day, -3.0), (1, 7, day, 0.0), (1, 8, day, 4.0), (1, 8, day, -1.0), (1, 9, day, 2.0), (1, 10, day, None)],
        "store int, item int, snapshot date, current_qty double")
    by_store = agg.agg_stock_by_store(stock)
    got = {r.item: tuple(r)[3:] for r in by_store.collect()}
    assert got[7] == (0.0, 0.0, 0.0, 2, 2, 1, 1)
    assert got[8] == (2.0, 4.0, 4.0, 2, 1, 0, 1)
    assert got[9] == (2.0, 2.0, 2.0, 1, 0, 0, 0)
    assert got[10] == (None, None, None, 0, 0, 1, 0)
    week = {r.item: r for r in agg.agg_stock_by_week(by_store).collect()}
    assert (week[8].avg_qty_by_week, week[7].num_zero_stock_week_all, week[8].num_zero_stock_week_part) == (2.0, 1, 1)
    assert week[10].avg_qty_by_week is None


def test_smoothing_looks_two_weeks_around(spark):
    weekly = spark.createDataFrame([(1, 1, w, float(q)) for w, q in [(1, 10), (2, 20), (4, 40), (9, 90)]],
                                   "store int, item int, week_num int, item_qty double")
    got = {r.week_num: r.s for r in agg.smooth(weekly, ["store", "item"], "item_qty", "s").collect()}
    assert got == {1: 15.0, 2: pytest.approx(70 / 3), 4: 30.0, 9: 90.0}


def test_scaling_by_the_best_week(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 8.0), (1, None), (2, 0.0), (3, None)], "k int, v double")
    assert rows(agg.scale_by_max(df, ["k"], "v", "s"), "k", "s") == [(1, 0.25), (1, 1.0), (1, None), (2, 0.0), (3, 0.0)]


def test_weeks_to_rebuild(spark):
    source = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 3, 6),)], "sell_date date")
    loaded = spark.createDataFrame([(2810,), (2815,)], "week_num int")
    bounds = agg.load_bounds(loaded, source, 12)
    assert tuple(bounds.first()) == (D(2024, 1, 1), D(2024, 3, 6), 2803, 2826)
    empty = agg.load_bounds(loaded.where("false"), source, 12)
    assert empty.first().min_week == 2505
    kept = agg.weeks_to_rebuild(loaded.withColumn("w", loaded.week_num), loaded.week_num, bounds)
    assert kept.count() == 2


def test_ticket_lines_are_summed(spark):
    stamp = dt.datetime(2024, 1, 1)
    columns = ("store int, checkout_number int, ticket_number int, sell_date date, ticket_time string, transaction_type string,"
               "item int, purchase_price double, total_cost double, total_cost_wo_tax double, item_qty double,"
               "total_margin double, num_acp string, num_cde string, created_dttm timestamp, load_dttm timestamp")
    line = (1, 1, 1, D(2024, 1, 1), "12:00", "S", 5, 2.0, 4.0, 3.0, 2.0, 1.0, None, None)
    df = spark.createDataFrame([(*line, stamp, stamp), (*line, stamp + dt.timedelta(1), stamp)], columns)
    got = agg.aggregate_ticket_lines(df).collect()
    assert len(got) == 1
    assert (got[0].total_cost, got[0].item_qty, got[0].created_dttm) == (8.0, 4.0, stamp)
