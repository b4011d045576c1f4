"""DuckDB SQL giving the expected result of each registered query."""

from __future__ import annotations

import re

from shelfline.operators.features import (
    BASIC, BASIC_REACH, BY_ITEM, BY_STORE, EXTENDED_REACH, Measure, Reach, week_offsets, year_offsets,
)

WEEK = "CAST(floor((date_diff('day', DATE '1970-01-01', {0}) + 3) / 7.0) AS INTEGER)"


def week(day: str) -> str:
    return WEEK.format(day)


def week_cols(day: str) -> str:
    year = f"CAST(year(date_trunc('week', {day})) AS INTEGER)"
    return (f"{year} AS year, {week(day)} - {week(f'make_date({year} - 1, 12, 31)')} AS week, "
            f"{week(day)} AS week_num")


def r(*columns: str) -> str:
    """Columns rounded like the queries' results."""
    return ", ".join(f"round({c}, 6) AS {c.split('.')[-1]}" for c in columns)


def exact_sum(value: str) -> str:
    """A sum whose bits do not depend on the order of addition: whole multiples of 2 ** -20, and the rest of 2 ** -63."""
    scaled = f"({value}) * 1048576.0::DOUBLE"
    return (f"(CAST(sum(CAST(floor({scaled}) AS BIGINT)) AS DOUBLE) / 1048576.0::DOUBLE + CAST(sum(CAST(floor(({scaled} - floor({scaled})) "
            "* 8796093022208.0::DOUBLE) AS BIGINT)) AS DOUBLE) / 9223372036854775808.0::DOUBLE)")


def exact_mean(value: str) -> str:
    return f"{exact_sum(value)} / count({value})"


LEVEL_COLUMNS = [f"avg_item_qty_by_{level}_scaled" for level in ("class", "subclass", "model")]

# Named subqueries; each may use the others.
PARTS: dict[str, str] = {
    "tickets": """
        SELECT CAST(l_suppkey % 10 AS INTEGER) AS store, l_partkey AS item, CAST(l_shipdate AS DATE) AS sell_date,
               l_quantity AS item_qty, l_extendedprice AS total_cost, l_returnflag = 'R' AS online
        FROM lineitem""",
    "daily": f"""
        SELECT sell_date, store, item, count(*) AS tickets_qty, {exact_sum('total_cost')} AS total_cost,
               sum(item_qty) AS item_qty,
               round_even({exact_sum('total_cost')} / nullif(sum(item_qty), 0), 0) AS purchase_price
        FROM tickets WHERE CAST(item AS VARCHAR) NOT LIKE '49%' GROUP BY ALL""",
    "o": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "orders_new": "SELECT * FROM o WHERE o_orderdate >= DATE '2000-01-01'",
    "orders_old": "SELECT * FROM o WHERE o_orderdate < DATE '2000-01-01'",
    "attrs": """
        SELECT p_partkey AS item,
               split_part(p_brand, '#', 2) || '|' || p_size || '|' || p_type AS dept_class_subclass,
               CASE WHEN p_size = 1 THEN '-1' ELSE CAST(p_size AS VARCHAR) END AS model
        FROM part WHERE p_type <> 'PROMO'""",
    "first_sale": """
        SELECT item, min(day) AS item_first_sale_date
        FROM (SELECT item, sell_date AS day FROM tickets
              UNION ALL
              SELECT l_partkey, CAST(o_orderdate AS DATE) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        WHERE item > 0 GROUP BY item""",
    "caps": """
        WITH side AS (
            SELECT item, online, count(*) AS n, max(item_qty) AS top,
                   quantile_cont(item_qty, 0.95) * CASE WHEN online THEN 1 ELSE 1.5 END AS high
            FROM tickets GROUP BY item, online),
        both_sides AS (
            SELECT item,
                   coalesce(f.n, 0) AS fn, coalesce(f.top, 0) AS ft, coalesce(f.high, 0) AS fh,
                   coalesce(w.n, 0) AS wn, coalesce(w.top, 0) AS wt, coalesce(w.high, 0) AS wh
            FROM (SELECT * FROM side WHERE NOT online) f
            FULL JOIN (SELECT * FROM side WHERE online) w USING (item))
        SELECT item,
               CASE WHEN fn >= wn THEN if(fn > 10, fh, ft) ELSE if(wn > 10, wh, wt) END AS item_qty_max_offline,
               CASE WHEN wn > 10 THEN wh WHEN wn >= fn THEN wt WHEN fn > 10 THEN fh ELSE ft END
                   AS item_qty_max_online
        FROM both_sides""",
    "weekly": f"""
        SELECT {week_cols('sell_date')}, store, item, sum(item_qty) AS item_qty,
               avg(item_qty) AS avg_item_qty, avg(purchase_price) AS avg_purchase_price
        FROM daily GROUP BY ALL""",
    "basic": f"""
        SELECT * REPLACE ({r('item_qty', 'avg_item_qty', 'avg_purchase_price', 'smooth_item_qty')}) FROM basic_exact""",
    "basic_exact": """
        SELECT a.*, (SELECT avg(b.item_qty) FROM weekly b WHERE b.store = a.store AND b.item = a.item
                     AND abs(b.week_num - a.week_num) <= 2) AS smooth_item_qty
        FROM weekly a""",
    "calendar": f"""
        WITH w AS (SELECT DISTINCT {week_cols('sell_date')} FROM tickets)
        SELECT year, week, week_num,
               CAST(week_num - ({week('make_date(year, 12, 31)')} - min(week_num) OVER (PARTITION BY year) + 1)
                    AS INTEGER) AS prev_week_num
        FROM w""",
    "exceptions": """
        SELECT year, week_num, week_num + 52 AS next_week_num FROM calendar WHERE week IN (10, 19, 45)""",
    "stock": f"""
        SELECT {week('sell_date')} AS week_num, store, item, avg(q) AS avg_week_qty_by_store,
               max(q) AS max_week_qty_by_store, sum(q) AS sum_week_qty, count(q) AS cnt_days_in_week,
               count(*) FILTER (q = 0) AS zero_qty_cnt_by_store,
               CAST(count(q) = count(*) FILTER (q = 0) AS INTEGER) AS is_zero_qty_week,
               CAST(count(*) FILTER (q = 0) > 0 AS INTEGER) AS is_zero_qty_week_part
        FROM (SELECT *, CASE WHEN item_qty < 25 THEN 0 ELSE item_qty - 25 END AS q FROM tickets)
        GROUP BY ALL""",
    "store_weeks": f"""
        SELECT s.year, s.week, s.week_num, s.store, s.item, dept_class_subclass, model,
               week_item_qty, sum_purchase_price, count_tickets
        FROM (SELECT {week_cols('sell_date')}, store, item, sum(item_qty) AS week_item_qty,
                     sum(purchase_price) AS sum_purchase_price, count(item_qty) AS count_tickets
              FROM daily JOIN part ON item = p_partkey
              WHERE p_size <= 45 OR sell_date < DATE '1999-01-01' - 14
              GROUP BY ALL) s
        LEFT JOIN attrs USING (item)""",
    "scaled": f"""
        WITH tops AS (SELECT store, item, max(week_item_qty) AS top FROM store_weeks GROUP BY ALL)
        SELECT t.year, t.week, t.week_num, t.item, t.dept_class_subclass, t.model,
               {exact_mean("CASE WHEN s.item IS NULL THEN NULL WHEN top = 0 THEN 0.0::DOUBLE ELSE week_item_qty / top END")}
                   AS avg_item_qty_scaled_with_stock
        FROM store_weeks t JOIN tops USING (store, item)
        LEFT JOIN stock s
               ON s.week_num = t.week_num AND s.store = t.store AND s.item = t.item
        GROUP BY ALL""",
    "item_sums": """
        SELECT year, week, week_num, item, dept_class_subclass, model, sum(week_item_qty) AS sum_item_qty,
               sum(sum_purchase_price) / sum(count_tickets) AS avg_purchase_price
        FROM store_weeks GROUP BY ALL""",
    "by_class": f"""
        SELECT year, week, week_num, regexp_extract(dept_class_subclass, '^[^|]*[|][^|]*') AS dept_class,
               {exact_mean('avg_item_qty_scaled_with_stock')} AS avg_item_qty_by_class
        FROM scaled GROUP BY ALL""",
    "by_subclass": f"""
        SELECT year, week, week_num, dept_class_subclass,
               {exact_mean('avg_item_qty_scaled_with_stock')} AS avg_item_qty_by_subclass
        FROM scaled GROUP BY ALL""",
    "by_model": f"""
        SELECT year, week, week_num, model, {exact_mean('avg_item_qty_scaled_with_stock')} AS avg_item_qty_by_model
        FROM scaled GROUP BY ALL""",
    "levels": """
        SELECT week_num, 'class' AS level, dept_class AS name, avg_item_qty_by_class AS v FROM by_class
        UNION ALL SELECT week_num, 'subclass', dept_class_subclass, avg_item_qty_by_subclass FROM by_subclass
        UNION ALL SELECT week_num, 'model', model, avg_item_qty_by_model FROM by_model""",
    "level_tops": "SELECT level, name, max(v) AS top FROM levels WHERE name IS NOT NULL GROUP BY ALL",
    "level_scaled": """
        SELECT week_num, level, name, CASE WHEN top IS NULL OR top = 0 THEN 0 ELSE v / top END AS v
        FROM levels JOIN level_tops USING (level, name)""",
    "attr_weeks": """
        SELECT i.*, c.v AS avg_item_qty_by_class_scaled, s.v AS avg_item_qty_by_subclass_scaled,
               m.v AS avg_item_qty_by_model_scaled,
               sum_item_qty / (SELECT max(sum_item_qty) FROM item_sums z WHERE z.item = i.item) AS sum_item_qty_scaled
        FROM item_sums i
        LEFT JOIN level_scaled c ON c.level = 'class' AND c.week_num = i.week_num
              AND c.name = regexp_extract(i.dept_class_subclass, '^[^|]*[|][^|]*')
        LEFT JOIN level_scaled s ON s.level = 'subclass' AND s.week_num = i.week_num AND s.name = i.dept_class_subclass
        LEFT JOIN level_scaled m ON m.level = 'model' AND m.week_num = i.week_num AND m.name = i.model""",
    "attr_store_weeks": """
        SELECT i.year, i.week, i.week_num, i.store, i.item, i.dept_class_subclass, i.model, i.week_item_qty,
               sum_purchase_price / count_tickets AS avg_purchase_price,
               c.v AS avg_item_qty_by_class_scaled, s.v AS avg_item_qty_by_subclass_scaled,
               m.v AS avg_item_qty_by_model_scaled,
               week_item_qty / (SELECT max(week_item_qty) FROM store_weeks z
                                WHERE z.item = i.item AND z.store = i.store) AS week_item_qty_scaled
        FROM store_weeks i
        LEFT JOIN level_scaled c ON c.level = 'class' AND c.week_num = i.week_num
              AND c.name = regexp_extract(i.dept_class_subclass, '^[^|]*[|][^|]*')
        LEFT JOIN level_scaled s ON s.level = 'subclass' AND s.week_num = i.week_num AND s.name = i.dept_class_subclass
        LEFT JOIN level_scaled m ON m.level = 'model' AND m.week_num = i.week_num AND m.name = i.model""",
    "lines": """
        SELECT CAST(l_suppkey % 10 AS INTEGER) AS store, CAST(l_suppkey % 4 AS INTEGER) AS checkout_number,
               l_orderkey AS ticket_number, CAST(l_shipdate AS DATE) AS sell_date, '12:00' AS ticket_time,
               l_returnflag AS transaction_type, l_partkey AS item,
               round_even(l_extendedprice / l_quantity, 0) AS purchase_price, l_extendedprice AS total_cost,
               l_extendedprice * (1 - l_tax) AS total_cost_wo_tax, l_quantity AS item_qty,
               l_extendedprice * l_discount AS total_margin, '0' AS num_acp, l_linestatus AS num_cde,
               l_shipdate AS created_dttm, l_shipdate + to_seconds(l_linenumber) AS load_dttm
        FROM lineitem""",
    "loaded": """
        SELECT DISTINCT store, checkout_number, ticket_number, sell_date, transaction_type, item, purchase_price, num_cde
        FROM lines WHERE sell_date < DATE '2001-01-01' AND NOT (month(sell_date) = 12 AND transaction_type = 'R')""",
    "old_versions": "SELECT * FROM versions WHERE is_old",
    "new_versions": "SELECT * FROM versions WHERE NOT is_old",
    "versions": """
        WITH started AS (
            SELECT o_custkey, o_orderdate, o_orderdate < DATE '2000-01-01' AS is_old,
                   max(o_orderkey) AS o_orderkey, max(o_totalprice) AS o_totalprice
            FROM o GROUP BY ALL),
        chained AS (
            SELECT *, lead(o_orderdate) OVER (PARTITION BY is_old, o_custkey ORDER BY o_orderdate) AS following
            FROM started)
        SELECT is_old, o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS TIMESTAMP) AS created_dttm,
               CAST(o_orderdate AS TIMESTAMP) AS valid_from_dttm,
               coalesce(CAST(following AS TIMESTAMP) - INTERVAL 1 SECOND, TIMESTAMP '2999-12-31') AS valid_to_dttm,
               CAST(o_orderdate AS TIMESTAMP) AS updated_dttm, if(following IS NULL, '1', '0') AS is_actual,
               CAST(o_orderdate AS TIMESTAMP) AS load_dttm
        FROM chained""",
    "bounds": """
        SELECT o_custkey, min(valid_from_dttm) AS inc_from, max_by(valid_to_dttm, valid_from_dttm) AS inc_to
        FROM new_versions GROUP BY o_custkey""",
    "attribute_docs": """
        SELECT p_partkey, p_size, p_type,
               '{"12963": ["' || p_name || '"], "model_modelID": ["' || (p_partkey * 7) || '"], "01181": ["' || p_type
               || '"], "letterRange": ["' || p_type[1] || '"], "mgtNomencProduct_mgtNomenc_departmentID": ["'
               || (p_size * 8) || '"], "mgtNomencProduct_mgtNomenc_subDepartmentID": ["' || split_part(p_brand, '#', 2)
               || '"], "mgtNomencProduct_mgtNomenc_categoryID": ["' || p_brand || '"]}' AS doc
        FROM part""",
    "family_docs": """
        SELECT p_partkey, p_size,
               CASE WHEN p_size < 5 THEN '[]' ELSE '[{"id": "' || p_brand || '", "type": "STANDARD"}, {"id": "' || p_type
               || '", "type": "OTHER"}, {"id": "' || p_name || '", "type": "STANDARD"}]' END AS doc
        FROM part WHERE p_type <> 'SMALL'""",
}

def with_parts(select: str) -> str:
    """Put the named subqueries a statement uses in front of it, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"(\bFROM|\bJOIN|,)\s+{name}\b(?!\.)", text):
                visit(PARTS[name])
                needed.append(name)

    visit(select)
    if not needed:
        return select
    # Each part is used several times by the wide features: compute it once.
    parts = "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n]})" for n in needed)
    own = select.strip()
    return f"{parts},\n{own.removeprefix('WITH ')}" if own.startswith("WITH ") else f"{parts}\n{own}"


def week_features(source: str, keys: list[str], measures: list[Measure], reach: Reach) -> str:
    """Same-year features as a self join with one filtered sum per column."""
    sums = ", ".join(
        f"sum(p.{m.column}) FILTER (p.week_num = w.week_num + {d}) AS {m.week}_{suffix}"
        for suffix, d in week_offsets(reach.left, reach.right) for m in measures)
    same = " AND ".join(f"p.{k} = w.{k}" for k in keys)
    own = ", ".join(f"any_value(w.{m.column}) AS {m.column}" for m in measures)
    named = ", ".join(f"w.{k}" for k in ["year", "week", "week_num", *keys])
    return (f"SELECT {named}, {own}, {sums} FROM {source} w LEFT JOIN {source} p ON {same} "
            f"AND p.week_num BETWEEN w.week_num - {reach.left} AND w.week_num + {reach.right} GROUP BY {named}")


def year_features(source: str, keys: list[str], measures: list[Measure], reach: Reach) -> str:
    """Prior-year features as a self join around last year's matching week."""
    sums = ", ".join(
        f"sum(p.{m.column}) FILTER (p.week_num = c.prev_week_num + {d}) AS {m.year}_{suffix}"
        for suffix, d in year_offsets(reach.year_left, reach.year_right) for m in measures)
    same = " AND ".join(f"p.{k} = w.{k}" for k in keys)
    named = ", ".join(f"w.{k}" for k in ["year", "week", "week_num", *keys])
    return (f"SELECT {named}, {sums} FROM {source} w JOIN calendar c ON c.week_num = w.week_num JOIN {source} p ON {same} "
            f"AND p.week_num BETWEEN c.prev_week_num - {reach.year_left} AND c.prev_week_num + {reach.year_right} "
            f"GROUP BY {named}")


def feature_names(measures: list[Measure], reach: Reach) -> tuple[list[str], list[str]]:
    return (
        [f"{m.week}_{s}" for s, _ in week_offsets(reach.left, reach.right) for m in measures],
        [f"{m.year}_{s}" for s, _ in year_offsets(reach.year_left, reach.year_right) for m in measures],
    )


def add_feature_parts(prefix: str, source: str, keys: list[str], measures: list[Measure], reach: Reach) -> None:
    PARTS[f"{prefix}_by_week"] = week_features(source, keys, measures, reach)
    PARTS[f"{prefix}_by_year"] = year_features(source, keys, measures, reach)
    _, yearly = feature_names(measures, reach)
    same = " AND ".join(f"y.{k} = w.{k}" for k in ["week_num", *keys])
    PARTS[f"{prefix}_combined"] = (
        f"SELECT w.*, {', '.join('y.' + c for c in yearly)} FROM {prefix}_by_week w "
        f"LEFT JOIN {prefix}_by_year y ON {same}")


add_feature_parts("basic", "basic", ["store", "item"], BASIC, BASIC_REACH)
add_feature_parts("items", "attr_weeks", ["item"], BY_ITEM, EXTENDED_REACH)
add_feature_parts("pairs", "attr_store_weeks", ["store", "item"], BY_STORE, EXTENDED_REACH)

E_ = EXTENDED_REACH
PARTS["spans"] = f"""
    SELECT c.year, c.week_num,
           min(e.week_num) FILTER (e.week_num >= c.week_num - {E_.left}) AS p1,
           max(e.week_num) FILTER (e.week_num <= c.week_num) AS p2,
           max(e.week_num) FILTER (e.week_num <= c.week_num + {E_.right}) AS n1,
           min(e.week_num) FILTER (e.week_num >= c.week_num) AS n2
    FROM calendar c LEFT JOIN exceptions e ON e.year = c.year GROUP BY ALL"""
PARTS["year_spans"] = f"""
    SELECT c.year, c.week_num,
           min(e.next_week_num) FILTER (e.next_week_num >= c.week_num - {E_.year_left}) AS p1,
           max(e.next_week_num) FILTER (e.next_week_num <= c.week_num) AS p2,
           max(e.next_week_num) FILTER (e.next_week_num <= c.week_num + {E_.year_right}) AS n1,
           min(e.next_week_num) FILTER (e.next_week_num >= c.week_num) AS n2
    FROM calendar c LEFT JOIN exceptions e ON e.year + 1 = c.year GROUP BY ALL"""


def masked(prefix: str, keys: list[str], measures: list[Measure], reach: Reach) -> str:
    """Features with those inside an exception span blanked."""
    def rule(alias: str, name: str, d: int, back: bool) -> str:
        if back:
            inside = f"{alias}.p1 IS NOT NULL AND f.week_num - {alias}.p2 <= {-d} AND f.week_num - {alias}.p1 >= {-d}"
        else:
            inside = f"{alias}.n1 IS NOT NULL AND {alias}.n2 - f.week_num <= {d} AND {alias}.n1 - f.week_num >= {d}"
        return f"CASE WHEN {inside} THEN NULL ELSE f.{name} END AS {name}"

    named = [f"f.{c}" for c in ["year", "week", "week_num", *keys, *[m.column for m in measures]]]
    weekly = [rule("s", f"{m.week}_{x}", d, d < 0) for x, d in week_offsets(reach.left, reach.right) for m in measures]
    yearly = [rule("t", f"{m.year}_{x}", d, d <= 0)
              for x, d in year_offsets(reach.year_left, reach.year_right) for m in measures]
    return (f"SELECT {', '.join(named + weekly + yearly)} FROM {prefix}_combined f "
            "JOIN spans s ON s.year = f.year AND s.week_num = f.week_num "
            "JOIN year_spans t ON t.year = f.year AND t.week_num = f.week_num "
            "WHERE f.week_num NOT IN (SELECT week_num FROM exceptions)")


def rollup(measures: list[Measure], reach: Reach) -> str:
    weekly, yearly = feature_names(measures, reach)
    columns = [m.column for m in measures] + weekly + yearly
    values = ", ".join(f"round({'avg' if 'price' in c else 'sum'}({c}), 6) AS {c}" for c in columns)
    return f"SELECT year, week, week_num, item, {values} FROM basic_combined GROUP BY year, week, week_num, item"


LATEST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"
ORDER_TIES = ("o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC, o_totalprice DESC, o_orderpriority DESC")
MERGED_ORDERS = f"SELECT * FROM o {LATEST.format(key='o_custkey', order=ORDER_TIES)}"
STATUS_TIES = ("o_orderdate DESC, CASE WHEN o_orderdate >= DATE '2000-01-01' THEN o_orderstatus END DESC, "
               "o_orderkey DESC")
BATCH_TIES = "CASE WHEN o_orderdate >= DATE '2000-01-01' THEN year(o_orderdate) ELSE 0 END DESC, o_orderkey DESC"
RANGE_8 = "SELECT max(sell_date) - 7 AS a, max(sell_date) AS b FROM tickets"
LINE_KEYS = "store, checkout_number, ticket_number, sell_date, ticket_time, transaction_type, item, purchase_price, num_acp, num_cde"
LINE_SUMS = ("round(sum(total_cost), 6) AS total_cost, round(sum(total_cost_wo_tax), 6) AS total_cost_wo_tax, "
             "round(sum(item_qty), 6) AS item_qty, round(sum(total_margin), 6) AS total_margin")


def stamp(*columns: str) -> str:
    return ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c.split('.')[-1]}" for c in columns)


PARTS["grid"] = f"""
    SELECT store, item, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
           AS sell_date
    FROM (SELECT DISTINCT store, item FROM daily), ({RANGE_8})"""
PARTS["priced"] = "SELECT store, item, sell_date, purchase_price FROM daily WHERE purchase_price > 0"
PARTS["priced_items"] = """
    SELECT item, sell_date, max(purchase_price) AS purchase_price FROM priced GROUP BY ALL"""
PARTS["rebuild"] = f"SELECT max({week('sell_date')}) - 7 AS a, max({week('sell_date')}) - 1 AS b FROM tickets"
PARTS["rebuild_grid"] = """
    SELECT store, item, DATE '1970-01-01' + CAST(7 * a - 3 + k AS INTEGER) AS sell_date
    FROM (SELECT DISTINCT store, item FROM daily), rebuild, range(0, 49) AS s(k)"""


def filled(grid: str) -> str:
    """Calendar rows with own, earlier or later price."""
    return f"""
        SELECT g.sell_date, g.store, g.item, coalesce(d.tickets_qty, 0) AS tickets_qty,
               coalesce(d.total_cost, 0) AS total_cost, coalesce(d.item_qty, 0) AS item_qty,
               coalesce(nullif(d.purchase_price, 0), p.purchase_price, n.purchase_price, -1) AS purchase_price
        FROM {grid} g
        LEFT JOIN daily d ON d.sell_date = g.sell_date AND d.store = g.store AND d.item = g.item
        ASOF LEFT JOIN priced p ON p.store = g.store AND p.item = g.item AND g.sell_date > p.sell_date
        ASOF LEFT JOIN priced n ON n.store = g.store AND n.item = g.item AND g.sell_date < n.sell_date
        JOIN first_sale f ON f.item = g.item
        WHERE g.sell_date >= f.item_first_sale_date"""


PARTS["listed_tickets"] = "SELECT * FROM tickets WHERE store IN (1, 2, 3, 5, 8)"
PARTS["listed_caps"] = PARTS["caps"].replace("FROM tickets", "FROM listed_tickets")
PARTS["rebuilt"] = filled("rebuild_grid")

# The same marts drawn from capped quantities, the weekly ones over the dense calendar.
PARTS["chain_daily"] = f"""
    SELECT sell_date, store, item, count(*) AS tickets_qty, {exact_sum('total_cost')} AS total_cost,
           sum(least(item_qty, item_qty_max_offline)) AS item_qty,
           round_even({exact_sum('total_cost')} / nullif(sum(item_qty), 0), 0) AS purchase_price
    FROM tickets LEFT JOIN caps USING (item)
    WHERE CAST(item AS VARCHAR) NOT LIKE '49%' GROUP BY sell_date, store, item"""
for part in ("priced", "rebuild_grid", "rebuilt", "basic_exact", "basic"):
    PARTS[f"chain_{part}"] = re.sub(
        r"\b(FROM|JOIN) (daily|priced|rebuild_grid|weekly|basic_exact)\b", r"\1 chain_\2", PARTS[part])
PARTS["chain_weekly"] = PARTS["weekly"].replace("FROM daily", "FROM chain_rebuilt")

# The extended marts over the dense calendar, where an item may have sold nothing in all weeks.
EXTENDED_PARTS = ["store_weeks", "scaled", "item_sums", "by_class", "by_subclass", "by_model", "levels", "level_tops",
                  "level_scaled", "attr_weeks", "attr_store_weeks"]
for part in EXTENDED_PARTS:
    PARTS[f"chain_{part}"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(EXTENDED_PARTS)})\b", r"\1 chain_\2", PARTS[part])
PARTS["chain_store_weeks"] = PARTS["chain_store_weeks"].replace("FROM daily", "FROM chain_rebuilt").replace(
    "sum(item_qty)", exact_sum("item_qty"))
PARTS["chain_daily"] = PARTS["chain_daily"].replace(
    "sum(least(item_qty, item_qty_max_offline))", exact_sum("least(item_qty, item_qty_max_offline)"))
PARTS["chain_item_sums"] = PARTS["chain_item_sums"].replace("sum(week_item_qty)", exact_sum("week_item_qty"))
for part, value in (("attr_weeks", "sum_item_qty"), ("attr_store_weeks", "week_item_qty")):
    PARTS[f"chain_{part}"] = re.sub(
        rf"{value} / (\(SELECT max.*?\)) AS", rf"coalesce({value} / nullif(\1, 0), 0) AS", PARTS[f"chain_{part}"], flags=re.S)
add_feature_parts("chain_items", "chain_attr_weeks", ["item"], BY_ITEM, EXTENDED_REACH)
add_feature_parts("chain_pairs", "chain_attr_store_weeks", ["store", "item"], BY_STORE, EXTENDED_REACH)


def rounded_masked(prefix: str, keys: list[str], measures: list[Measure]) -> str:
    names = [m.column for m in measures] + sum(feature_names(measures, EXTENDED_REACH), [])
    return (f"SELECT year, week, week_num, {', '.join(keys)}, {r(*names)} "
            f"FROM ({masked(prefix, keys, measures, EXTENDED_REACH)})")


STORE_LIST = "(1, 2, 3, 5, 8)"
WEEK_NAMES = [2818 + i for i in range(5)]

ORACLES: dict[str, str] = {
    "full_replace_roundtrip": MERGED_ORDERS,
    "partition_replace_roundtrip": """
        SELECT CAST(year(sell_date) AS INTEGER) AS year, CAST(month(sell_date) AS INTEGER) AS month, store,
               count(*) AS tickets, sum(item_qty) AS item_qty
        FROM tickets WHERE year(sell_date) >= 1999 OR online GROUP BY ALL""",
    "upsert_batches": f"SELECT * FROM o {LATEST.format(key='o_custkey', order=STATUS_TIES)}",
    "upsert_newest_batch": f"""SELECT * FROM o {LATEST.format(key='o_custkey', order=BATCH_TIES)}""",
    "upsert_untouched": f"SELECT *, true AS only_touched FROM o {LATEST.format(key='o_custkey', order=ORDER_TIES)}",
    "dump_resumed": """
        SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_orderdate >= DATE '2000-01-01' AS INTEGER) AS dump,
               count(*) OVER (PARTITION BY o_orderdate >= DATE '2000-01-01') AS rows_written
        FROM o""",
    "current_view": "SELECT o_orderkey, o_custkey, o_orderdate FROM o WHERE o_orderstatus <> 'F'",
    "incremental_dump_slice": """
        SELECT o_orderkey, o_custkey, o_orderdate, count(*) OVER () AS rows_written
        FROM o WHERE o_orderdate > DATE '1998-01-01' AND o_orderdate <= DATE '1999-06-30'""",
    "export_projection": f"SELECT event_id, {stamp('ts')}, user_id, event_type, {r('value')}, props FROM events",
    "range_replace_roundtrip": """
        SELECT CAST(year(sell_date) AS INTEGER) AS year, store, online, count(*) AS tickets,
               round(sum(item_qty), 6) AS item_qty
        FROM tickets
        WHERE NOT (year(sell_date) BETWEEN 1997 AND 1999) OR (online AND year(sell_date) <> 1998)
        GROUP BY ALL""",
    "export_schema_cast": "SELECT p_partkey, p_name AS p_name, CAST(p_size AS INTEGER) AS p_size FROM part",
    "filter_stores": f"SELECT store, item, sell_date, item_qty FROM tickets WHERE store IN {STORE_LIST}",
    "filter_not_like": """
        SELECT item, count(*) AS tickets, sum(item_qty) AS item_qty FROM tickets
        WHERE CAST(item AS VARCHAR) NOT LIKE '49%' GROUP BY item""",
    "filter_between": """
        SELECT sell_date, count(*) AS tickets FROM tickets
        WHERE sell_date BETWEEN DATE '1997-03-01' AND DATE '1998-08-31' GROUP BY sell_date""",
    "filter_recent": """
        SELECT o_orderkey, o_orderdate, o_totalprice FROM o WHERE o_orderdate >= DATE '2001-08-01' - 30""",
    "case_flags": """
        SELECT p_partkey, if(p_type = 'SMALL', '1', '0') AS same_type, if(p_size > 40, '1', '0') AS same_model_id,
               CASE WHEN p_size < 10 THEN 'low' WHEN p_size < 30 THEN 'mid' ELSE 'high' END AS band
        FROM part""",
    "distinct_store_item": "SELECT DISTINCT store, item FROM tickets",
    "distinct_store_sorted": "SELECT DISTINCT store FROM tickets ORDER BY store",
    "scalar_weeks": f"""
        SELECT DISTINCT o_orderdate, {week_cols('o_orderdate')},
               CAST(date_trunc('week', o_orderdate) AS DATE) AS monday FROM o""",
    "scalar_casts": """
        SELECT p_partkey, CAST(if(p_size * 8 <= 255, p_size * 8, NULL) AS INTEGER) AS as_u8,
               CAST(if(p_partkey * 97 <= 65535, p_partkey * 97, NULL) AS INTEGER) AS as_u16,
               TRY_CAST(TRY_CAST('42949672' || split_part(p_brand, '#', 2) AS UINTEGER) AS BIGINT) AS as_u32,
               CAST(NULL AS BIGINT) AS not_a_number,
               CAST(split_part(p_brand, '#', 2) AS INTEGER) AS int_or_zero, 0 AS zero,
               CAST(p_partkey AS INTEGER) AS padded, p_partkey AS padded_u32
        FROM part""",
    "scalar_dates": f"""
        SELECT o_orderkey, if(o_orderpriority = '5-LOW', NULL, o_orderdate) AS parsed,
               o_orderdate + 14 AS in_two_weeks,
               strftime(CAST(o_orderdate AS TIMESTAMP) - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS second_before,
               strftime(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS second_after
        FROM o""",
    "scalar_split_key": """
        SELECT p_partkey, p_brand || '|' || p_size || '|' || p_type AS key, p_brand || '|' || p_size AS two,
               p_brand AS one FROM part""",
    "natural_key": """
        SELECT p_partkey AS item, if(p_size = 1, NULL, p_partkey || '|' || p_size || '|'
               || if(p_type = 'PROMO', '0', '1')) AS nk FROM part""",
    "scalar_null_rules": """
        SELECT store, count(*) FILTER (q > 20 OR q < -20 OR q = 0) AS nothing,
               sum(q) FILTER (q > 0 AND q <= 20) AS positive,
               min(least(if(q > 0 AND q <= 20, q, 3), 3)) AS least
        FROM (SELECT store, item_qty - 25 AS q FROM tickets) GROUP BY store""",
    "json_props": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, doc->>'$."12963"[0]' AS name,
               doc->>'$.model_modelID[0]' AS model,
               doc->>'$.mgtNomencProduct_mgtNomenc_subCategoryID[0]' AS missing,
               doc->>'$.letterRange[0]' AS gamma
        FROM attribute_docs""",
    "json_array_filter": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(json_array_length(doc) AS INTEGER) AS entries,
               array_to_string(list_transform(
                   list_filter(from_json(doc, '[{"id":"VARCHAR","type":"VARCHAR"}]'), lambda e: e.type = 'STANDARD'),
                   lambda e: e.id), ',') AS standard
        FROM family_docs""",
    "join_inner_attr": """
        SELECT dept_class_subclass, model, count(*) AS tickets, sum(item_qty) AS item_qty
        FROM tickets JOIN attrs USING (item) GROUP BY ALL""",
    "join_inner_multi": """
        SELECT week_num, store, item, week_item_qty, sum_week_qty, is_zero_qty_week
        FROM store_weeks JOIN stock USING (week_num, store, item)""",
    "join_left_attrs": f"""
        SELECT week_num, item, item_qty, dept_class_subclass, model
        FROM (SELECT {week('sell_date')} AS week_num, item, sum(item_qty) AS item_qty FROM daily GROUP BY ALL)
        LEFT JOIN attrs USING (item)""",
    "anti_no_increment": """
        SELECT o_orderkey, o_custkey, o_orderdate FROM orders_old
        WHERE o_custkey NOT IN (SELECT o_custkey FROM orders_new)""",
    "asof_past": """
        SELECT a.sell_date, a.store, a.item, b.purchase_price AS price_past
        FROM daily a ASOF LEFT JOIN priced b ON a.store = b.store AND a.item = b.item AND a.sell_date > b.sell_date""",
    "asof_future": """
        SELECT a.sell_date, a.store, a.item, b.purchase_price AS price_future,
               CAST(date_diff('day', DATE '1970-01-01', b.sell_date) AS INTEGER) AS day_future
        FROM daily a ASOF LEFT JOIN priced_items b ON a.item = b.item AND a.sell_date < b.sell_date""",
    "asof_inclusive": f"""
        SELECT w.*, p.week_num AS exception_before, n.week_num AS exception_after
        FROM (SELECT {week_cols('sell_date')}, item, sum(item_qty) AS item_qty FROM daily GROUP BY ALL) w
        ASOF LEFT JOIN exceptions p ON w.year = p.year AND w.week_num >= p.week_num
        ASOF LEFT JOIN exceptions n ON w.year = n.year AND w.week_num <= n.week_num""",
    "asof_offset": f"""
        SELECT w.*, p.week_num AS first_in_reach, n.week_num AS last_in_reach
        FROM (SELECT {week_cols('sell_date')}, item, sum(item_qty) AS item_qty FROM daily GROUP BY ALL) w
        ASOF LEFT JOIN (SELECT *, week_num + 8 AS at FROM exceptions) p ON w.year = p.year AND w.week_num <= p.at
        ASOF LEFT JOIN (SELECT *, week_num - 10 AS at FROM exceptions) n ON w.year = n.year AND w.week_num >= n.at""",
    "agg_ticket_lines": f"""
        SELECT {LINE_KEYS}, {LINE_SUMS}, min(created_dttm) AS created_dttm, min(load_dttm) AS load_dttm
        FROM lines GROUP BY ALL""",
    "outlier_caps": f"SELECT item, {r('item_qty_max_offline', 'item_qty_max_online')} FROM caps",
    "caps_of_stores": f"SELECT item, {r('item_qty_max_offline', 'item_qty_max_online')} FROM listed_caps",
    "first_sale_of_stores": f"""
        SELECT item, min(day) AS item_first_sale_date
        FROM (SELECT item, sell_date AS day FROM tickets WHERE online OR store IN {STORE_LIST}
              UNION ALL
              SELECT l_partkey, CAST(o_orderdate AS DATE) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              WHERE l_suppkey % 10 IN {STORE_LIST})
        WHERE item > 0 GROUP BY item""",
    "capped_quantities": f"""
        SELECT sell_date, store, item, count(*) AS tickets_qty, round(sum(total_cost), 6) AS total_cost,
               round(sum(least(item_qty, item_qty_max_offline)), 6) AS item_qty,
               round_even({exact_sum('total_cost')} / nullif(sum(item_qty), 0), 0) AS purchase_price
        FROM tickets LEFT JOIN caps USING (item)
        WHERE CAST(item AS VARCHAR) NOT LIKE '49%' GROUP BY sell_date, store, item""",
    "agg_day_store_item": f"""
        SELECT sell_date, store, item, tickets_qty, {r('total_cost', 'item_qty', 'purchase_price')} FROM daily""",
    "agg_day_store_item_split": f"""
        SELECT sell_date, store, item, count(*) AS tickets_qty, round(sum(total_cost), 6) AS total_cost,
               round(sum(least(item_qty, item_qty_max_offline)), 6) AS item_qty,
               round_even({exact_sum('total_cost')} / nullif(sum(item_qty), 0), 0) AS purchase_price
        FROM (SELECT *, item_qty AS raw FROM tickets) LEFT JOIN caps USING (item)
        WHERE CAST(item AS VARCHAR) NOT LIKE '49%'
        GROUP BY sell_date, store, item, raw""",
    "first_sale_date": "SELECT * FROM first_sale",
    "agg_week_store_item": f"""
        SELECT year, week, week_num, store, item, {r('item_qty', 'avg_item_qty', 'avg_purchase_price')} FROM weekly""",
    "smooth_week_qty": f"SELECT week_num, store, item, {r('item_qty', 'smooth_item_qty')} FROM basic",
    "agg_stock_by_store": f"""
        SELECT week_num, store, item, {r('avg_week_qty_by_store', 'max_week_qty_by_store', 'sum_week_qty')},
               cnt_days_in_week, zero_qty_cnt_by_store, is_zero_qty_week, is_zero_qty_week_part FROM stock""",
    "agg_stock_by_week": f"""
        SELECT week_num, item, round(sum(sum_week_qty) / sum(cnt_days_in_week), 6) AS avg_qty_by_week,
               round({exact_sum('avg_week_qty_by_store')}, 6) AS sum_avg_week_qty_by_store,
               round(sum(max_week_qty_by_store), 6) AS sum_max_week_qty_by_store,
               CAST(sum(is_zero_qty_week_part) AS BIGINT) AS num_zero_stock_week_part,
               CAST(sum(is_zero_qty_week) AS BIGINT) AS num_zero_stock_week_all
        FROM stock GROUP BY ALL""",
    "agg_tickets_by_store": "SELECT * FROM store_weeks",
    "avg_scaled_with_stock": f"SELECT * REPLACE ({r('avg_item_qty_scaled_with_stock')}) FROM scaled",
    "sum_tickets_by_week": f"SELECT * REPLACE ({r('sum_item_qty', 'avg_purchase_price')}) FROM item_sums",
    "avg_by_class": f"SELECT * REPLACE ({r('avg_item_qty_by_class')}) FROM by_class",
    "avg_by_subclass": f"SELECT * REPLACE ({r('avg_item_qty_by_subclass')}) FROM by_subclass",
    "avg_by_model": f"SELECT * REPLACE ({r('avg_item_qty_by_model')}) FROM by_model",
    "attr_by_week": "SELECT * FROM attr_weeks",
    "attr_by_store": "SELECT * FROM attr_store_weeks",
    "max_val_by_key": """
        SELECT item, store, max(week_item_qty) AS max_week_item_qty FROM store_weeks GROUP BY ALL""",
    "load_bounds": f"""
        SELECT min(sell_date) AS min_date, max(sell_date) AS max_date,
               (SELECT max({week('o_orderdate')}) - 12 FROM o) AS min_week, {week('max(sell_date)')} - 1 AS max_week
        FROM tickets""",
    "load_bounds_empty": f"""
        SELECT min(sell_date) AS min_date, max(sell_date) AS max_date,
               2505 AS min_week, {week('max(sell_date)')} - 1 AS max_week FROM tickets""",
    "partition_counts": "SELECT sell_date, count(*) AS rows FROM tickets GROUP BY sell_date",
    "latest_by_key": MERGED_ORDERS,
    "top_n_by_key": """
        SELECT o_custkey, o_orderkey, o_totalprice FROM o
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""",
    "merge_increment": MERGED_ORDERS,
    "merge_current_view": f"""
        SELECT * FROM (
            SELECT o_custkey || '|' || o_orderpriority AS nk, o_custkey, o_orderpriority, o_orderkey,
                   o_orderdate AS created_dttm, if(o_orderstatus <> 'F' AND o_orderdate >= DATE '2000-01-01', '1',
                   if(o_orderstatus <> 'F', '1', '0')) AS is_actual
            FROM o {LATEST.format(key='o_custkey, o_orderpriority',
                                  order="o_orderdate DESC, o_orderkey DESC")})
        WHERE is_actual = '1'""",
    "key_bounds": f"SELECT o_custkey, {stamp('inc_from', 'inc_to')} FROM bounds",
    "scd2_merge": f"""
        WITH closed AS (
            SELECT v.o_custkey, o_orderkey, o_totalprice, created_dttm,
                   if(valid_from_dttm >= inc_from, inc_to + INTERVAL 1 SECOND, valid_from_dttm) AS valid_from_dttm,
                   if(valid_to_dttm <= inc_to, inc_from - INTERVAL 1 SECOND, valid_to_dttm) AS valid_to_dttm,
                   TIMESTAMP '2002-01-01' AS updated_dttm, '0' AS is_actual, load_dttm
            FROM old_versions v JOIN bounds b ON b.o_custkey = v.o_custkey),
        last_closed AS (
            SELECT * FROM closed WHERE valid_from_dttm < valid_to_dttm
            {LATEST.format(key='o_custkey', order='valid_from_dttm DESC')}),
        everything AS (
            SELECT * EXCLUDE (is_old) FROM new_versions
            UNION ALL SELECT * FROM last_closed
            UNION ALL SELECT * EXCLUDE (is_old) FROM old_versions
                      WHERE is_actual = '0' OR o_custkey NOT IN (SELECT o_custkey FROM bounds))
        SELECT o_custkey, o_orderkey, o_totalprice,
               {stamp('created_dttm', 'valid_from_dttm', 'valid_to_dttm', 'updated_dttm')}, is_actual,
               {stamp('load_dttm')}
        FROM (SELECT * FROM everything
              {LATEST.format(key='o_custkey, valid_from_dttm', order='created_dttm DESC, updated_dttm')})""",
    "reconcile_partitions": f"""
        WITH differing AS (
            SELECT sell_date FROM (SELECT sell_date, count(*) AS n FROM lines GROUP BY ALL)
            LEFT JOIN (SELECT sell_date, count(*) AS m FROM loaded GROUP BY ALL) USING (sell_date)
            WHERE m IS DISTINCT FROM n)
        SELECT {LINE_KEYS}, {LINE_SUMS}, strftime(min(created_dttm), '%Y-%m-%d %H:%M:%S') AS created_dttm,
               strftime(min(load_dttm), '%Y-%m-%d %H:%M:%S') AS load_dttm
        FROM lines WHERE sell_date IN (SELECT sell_date FROM differing) GROUP BY {LINE_KEYS}""",
    "partitions_to_reload": f"""
        SELECT sell_date, n AS rows_raw, m AS rows_ods
        FROM (SELECT sell_date, count(*) AS n FROM (SELECT DISTINCT {LINE_KEYS} FROM lines) GROUP BY ALL)
        LEFT JOIN (SELECT sell_date, count(*) AS m FROM loaded GROUP BY ALL) USING (sell_date)
        WHERE m IS NULL OR m <> n""",
    "densify_calendar": f"""
        SELECT g.sell_date, g.store, g.item, tickets_qty, {r('total_cost', 'item_qty', 'purchase_price')}
        FROM grid g LEFT JOIN daily USING (sell_date, store, item)""",
    "densify_prices": f"""
        SELECT sell_date, store, item, tickets_qty, {r('total_cost', 'item_qty', 'purchase_price')}
        FROM ({filled('grid')})""",
    "weekly_rebuild": f"""
        SELECT {week_cols('sell_date')}, store, item, round(sum(item_qty), 6) AS item_qty,
               round(avg(item_qty), 6) AS avg_item_qty, round(avg(purchase_price), 6) AS avg_purchase_price
        FROM rebuilt GROUP BY ALL""",
    "chain_basic": week_features("chain_basic", ["store", "item"], BASIC, BASIC_REACH),
    "chain_extended": rounded_masked("chain_items", ["item"], BY_ITEM),
    "chain_extended_store": rounded_masked("chain_pairs", ["store", "item"], BY_STORE),
    "week_calendar": "SELECT * FROM calendar",
    "features_by_week": "SELECT * FROM basic_by_week",
    "features_by_year": "SELECT * FROM basic_by_year",
    "features_v1": rollup(BASIC, BASIC_REACH),
    "features_v2_week": "SELECT * FROM items_by_week",
    "features_v2_store_week": "SELECT * FROM pairs_by_week",
    "features_v2_year": "SELECT * FROM items_by_year",
    "features_v2_store_year": "SELECT * FROM pairs_by_year",
    "features_combined": "SELECT * FROM items_combined",
    "features_v2_masked": masked("items", ["item"], BY_ITEM, EXTENDED_REACH),
    "features_v2_store_masked": masked("pairs", ["store", "item"], BY_STORE, EXTENDED_REACH),
    "shred_products": f"""
        SELECT p_partkey AS item, a.doc->>'$."12963"[0]' AS name, p_partkey * 7 AS model,
               array_to_string(list_transform(
                   list_filter(from_json(f.doc, '[{{"id":"VARCHAR","type":"VARCHAR"}}]'), lambda e: e.type = 'STANDARD'),
                   lambda e: e.id), ',') AS families,
               p_type AS type, p_type[1] AS gamma,
               if(a.p_size * 8 <= 255, a.p_size * 8, NULL) AS dep,
               CAST(a.doc->>'$.mgtNomencProduct_mgtNomenc_subDepartmentID[0]' AS INTEGER) AS subdep,
               CAST(NULL AS INTEGER) AS class, CAST(NULL AS INTEGER) AS subclass,
               strftime(greatest(sa, sf), '%Y-%m-%d %H:%M:%S') AS valid_from_dttm,
               '2999-12-31 00:00:00' AS valid_to_dttm,
               strftime(greatest(sa, sf), '%Y-%m-%d %H:%M:%S') AS created_dttm,
               strftime(greatest(sa, sf), '%Y-%m-%d %H:%M:%S') AS updated_dttm, '1' AS is_actual
        FROM (SELECT *, TIMESTAMP '2024-01-01' + to_days(p_size) AS sa FROM attribute_docs) a
        LEFT JOIN (SELECT *, TIMESTAMP '2024-01-21' + to_hours(12 * p_size) AS sf FROM family_docs
                   WHERE doc <> '[]') f USING (p_partkey)
        WHERE greatest(sa, sf) >= TIMESTAMP '2024-02-20' - INTERVAL 30 DAY""",
    "item_attr": "SELECT * FROM attrs",
    "cluster_items": "SELECT DISTINCT user_id AS item, true AS in_range, true AS nearest FROM events",
    "cluster_certificate": "SELECT DISTINCT user_id AS item, true AS nearest, true AS centre_is_mean FROM events",
    "pivot_week_item": "SELECT user_id AS item, " + ", ".join(
        f"round(coalesce(sum(value) FILTER ({week('CAST(ts AS DATE)')} = {w}), 0), 6) AS w{w}" for w in WEEK_NAMES
    ) + " FROM events GROUP BY user_id",
}


def all_oracles() -> dict[str, str]:
    return {name: with_parts(select) for name, select in ORACLES.items()}
