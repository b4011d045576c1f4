"""Wide week-offset and prior-year features with exception-week masking."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.weeks import WEEK_KEYS, year_end_week
from shelfline.operators.asof import nearest_at_or_after, nearest_at_or_before


class Measure(NamedTuple):
    """A weekly value and the stems of its same-year and prior-year feature names."""

    column: str
    week: str
    year: str


class Reach(NamedTuple):
    """How many weeks features look back and ahead, this year and in the prior one."""

    left: int
    right: int
    year_left: int
    year_right: int


def measures_of(*columns: str, shorten: tuple[str, ...] = ()) -> list[Measure]:
    """Measures named after their columns; ``shorten`` ones drop '_scaled' in week features."""
    return [
        Measure(c, c.removesuffix("_scaled") if c in shorten else c, c) for c in columns
    ]


_LEVEL_MEANS = tuple(f"avg_item_qty_by_{level}_scaled" for level in ("class", "subclass", "model"))
BASIC = measures_of("item_qty", "smooth_item_qty", "avg_purchase_price")
BY_ITEM = measures_of("sum_item_qty_scaled", "avg_purchase_price", *_LEVEL_MEANS, shorten=_LEVEL_MEANS)
BY_STORE = measures_of("week_item_qty_scaled", "avg_purchase_price", *_LEVEL_MEANS, shorten=_LEVEL_MEANS)
BASIC_REACH = Reach(6, 6, 6, 12)
EXTENDED_REACH = Reach(8, 10, 12, 12)


def week_offsets(left: int, right: int) -> list[tuple[str, int]]:
    """Suffix and distance in weeks of every same-year feature."""
    return [(f"prev_w{i}", -i) for i in range(1, left + 1)] + [(f"next_w{i}", i) for i in range(1, right + 1)]


def year_offsets(left: int, right: int) -> list[tuple[str, int]]:
    """Suffix and distance from last year's matching week of every prior-year feature."""
    back = [(f"yw{i}", -i) for i in range(1, left + 1)]
    return [("y", 0), *back, *[(f"next_yw{i}", i) for i in range(1, right + 1)]]


def _rounded(value: str, places: int | None) -> str:
    return value if places is None else f"round({value}, {places})"


def _timelines(weekly: DataFrame, keys: list[str], measures: list[Measure], extra: list[str],
               places: int | None = None) -> DataFrame:
    """Per key its rows in order (``_rows``) and one entry per week from the first to the last (``_line``).

    An entry holds the sums of its week's rows; weeks without a row are null
    entries, so a week's entry is found by its distance from the first week. Rows
    of a week are added up only for keys that have several in some week, in the
    order of their values. Entries, not rows, are rounded to so many ``places``, if given.
    """
    columns = [m.column for m in measures]
    taken = ["week_num", "year", "week", *extra, *columns]
    grouped = weekly.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*dict.fromkeys(taken)))).alias("_rows"))
    sums = ", ".join(
        _rounded(f"aggregate(filter(_rows, r -> r.week_num = w), CAST(NULL AS DOUBLE), (s, r) -> coalesce(s + r.{c}, s, r.{c}))",
                 places) + f" AS {c}"
        for c in columns)
    own = ", ".join(_rounded(f"CAST(e.{c} AS DOUBLE)", places) + f" AS {c}" for c in columns)
    gap = "array_repeat(nullif(e, e), coalesce(get(_weeks, i + 1).week_num - e.week_num - 1, 0))"
    return grouped.selectExpr(
        *keys, "_rows", "_rows[0].week_num AS _first",
        "array_distinct(_rows.week_num) AS _nums",
    ).selectExpr(
        *keys, "_rows", "_first",
        f"if(size(_nums) = size(_rows), transform(_rows, e -> struct(e.week_num AS week_num, {own})), "
        f"transform(_nums, w -> struct(w AS week_num, {sums}))) AS _weeks",
    ).selectExpr(*keys, "_rows", "_first", f"flatten(transform(_weeks, (e, i) -> concat(array(e), {gap}))) AS _line")


def _slices(weekly: DataFrame, calendar: DataFrame | None, keys: list[str], measures: list[Measure],
            week_distances: list[tuple[str, int]], year_distances: list[tuple[str, int]],
            places: int | None = None) -> DataFrame:
    """Rows with the entries around their week (``_w``) and around last year's matching week (``_y``).

    One shuffle by key: every distance is an element of the key's own timeline, so
    neither windows over the weeks nor a join of wide rows is needed. A slice
    begins ``_w_skip`` or ``_y_skip`` entries late where the timeline begins later.
    """
    if calendar is None:
        lines = _timelines(weekly, keys, measures, [], places)
    else:
        lines = _lines_of_years(weekly, calendar, keys, measures, places)
    fields = [f"e.{c} AS {c}" for c in dict.fromkeys([*WEEK_KEYS, *[m.column for m in measures]])]
    for name, week, distances in (("_w", "e.week_num", week_distances), ("_y", "e.prev_week_num", year_distances)):
        if distances:
            fields += _slice("_line", "_first", week, distances, name)
    return lines.selectExpr(*keys, f"inline(transform(_rows, e -> struct({', '.join(fields)})))")


def _lines_of_years(weekly: DataFrame, calendar: DataFrame, keys: list[str], measures: list[Measure],
                    places: int | None = None) -> DataFrame:
    """The timelines, whose rows hold last year's matching week."""
    # One row per week of the calendar.
    rows = weekly.join(F.broadcast(calendar.select("week_num", "prev_week_num")), "week_num", "left")
    return _timelines(rows, keys, measures, ["prev_week_num"], places)


def _slice(line: str, first: str, week: str, distances: list[tuple[str, int]], name: str) -> list[str]:
    """The entries of a timeline at the distances from a week, and how many entries late they begin, as SQL text."""
    low, high = _span(distances)
    start = f"{week} - {first} + {low}"
    return [f"slice({line}, greatest({start}, 0) + 1, greatest({high - low + 1} + least({start}, 0), 0)) AS {name}",
            f"greatest(-({start}), 0) AS {name}_skip"]


def _span(distances: list[tuple[str, int]]) -> tuple[int, int]:
    """The least and the greatest distance, this week's included."""
    return min(0, *[d for _, d in distances]), max(0, *[d for _, d in distances])


def _looked_up(measures: list[Measure], week_distances: list[tuple[str, int]], year_distances: list[tuple[str, int]],
               masked: bool = False) -> list[str]:
    """The features as elements of the slices, as SQL text, which keeps building a few hundred columns cheap on the driver.

    ``masked`` leaves out the distances that ``_w_hide`` and ``_y_hide`` mark as hidden.
    """
    out = []
    for name, stem, distances in (("_w", "week", week_distances), ("_y", "year", year_distances)):
        if not distances:
            continue
        low, _ = _span(distances)
        for x, d in distances:
            entry = f"get({name}, {d - low} - {name}_skip)"
            for m in measures:
                value = f"{entry}.{m.column}"
                if masked:
                    value = f"if(get({name}_hide, {d - low}), NULL, {value})"
                out.append(f"{value} AS {getattr(m, stem)}_{x}")
    return out


def _spread(sliced: DataFrame, columns: list[str], features: list[str]) -> DataFrame:
    """The columns and the features looked up in the slices.

    Spark compiles so wide a projection into one method, which is too long for the JVM to
    compile any further and is interpreted. It compiles a projection that holds a lambda
    in short pieces, so the first column goes through one.
    """
    first, *others = columns
    return sliced.selectExpr(f"get(transform(array({first}), x -> x), 0) AS {first}", *others, *features)


def offset_features(weekly: DataFrame, keys: list[str], measures: list[Measure], reach: Reach,
                    spread: bool = True) -> DataFrame:
    """Every measure of the same key at each week distance within reach.

    Without ``spread`` the features stay in one timeline per key, for ``combine_features``.
    """
    if not spread:
        return _timelines(weekly, keys, measures, [])
    distances = week_offsets(reach.left, reach.right)
    return _spread(_slices(weekly, None, keys, measures, distances, []),
                   [*WEEK_KEYS, *keys, *[m.column for m in measures]], _looked_up(measures, distances, []))


def week_and_year_features(weekly: DataFrame, calendar: DataFrame, keys: list[str], measures: list[Measure],
                           reach: Reach) -> DataFrame:
    """Same-year and prior-year features of every row, in one pass over each key's weeks."""
    weeks, years = week_offsets(reach.left, reach.right), year_offsets(reach.year_left, reach.year_right)
    return _spread(_slices(weekly, calendar, keys, measures, weeks, years),
                   [*WEEK_KEYS, *keys, *[m.column for m in measures]], _looked_up(measures, weeks, years))


def masked_features(weekly: DataFrame, calendar: DataFrame, exceptions: DataFrame, keys: list[str],
                    measures: list[Measure], reach: Reach, places: int | None = None) -> DataFrame:
    """``week_and_year_features`` masked like ``mask_exceptions``, before they are spread over columns.

    What is hidden depends on the distance alone: each row gets one mark per
    distance, which its lookups heed; the slices stay as they are. Values are rounded
    to so many ``places``, if given: once per week, not once per feature it shows up in.
    """
    weeks, years = week_offsets(reach.left, reach.right), year_offsets(reach.year_left, reach.year_right)
    spans = _exception_spans(exceptions, reach)
    hides = []
    for name, distances in (("_w", weeks), ("_y", years)):
        low, high = _span(distances)
        known = {d: f"hide_{x}" for x, d in distances}
        hides.append(f"array({', '.join(known.get(d, 'false') for d in range(low, high + 1))}) AS {name}_hide")
    # Both sides are made of the exceptions, of which there is at most one per calendar week.
    near = F.broadcast(spans.selectExpr("year", "week_num", *hides))
    dropped = F.broadcast(exceptions.select("week_num").distinct())
    rows = weekly.select(*dict.fromkeys([*WEEK_KEYS, *keys, *[m.column for m in measures]]))
    sliced = _slices(rows, calendar, keys, measures, weeks, years, places).join(dropped, "week_num", "left_anti").join(
        near, ["year", "week_num"], "left")
    own = [m.column if places is None else f"{_rounded(m.column, places)} AS {m.column}" for m in measures]
    return _spread(sliced, [*WEEK_KEYS, *keys, *own],
                   _looked_up(measures, weeks, years, masked=True))


def week_calendar(weekly: DataFrame) -> DataFrame:
    """Weeks on record with the matching week of the year before.

    A week is moved back by the number of weeks from the first one on record in
    its year to the year's end.
    """
    weeks = weekly.select(*WEEK_KEYS).distinct()
    spans = weeks.groupBy("year").agg(
        (year_end_week(F.col("year")) - F.min("week_num") + 1).alias("_weeks"))
    # One row per year of the calendar.
    return weeks.join(F.broadcast(spans), "year", "left").select(
        *WEEK_KEYS, (F.col("week_num") - F.col("_weeks")).alias("prev_week_num"))


def prior_year_features(weekly: DataFrame, calendar: DataFrame, keys: list[str],
                        measures: list[Measure], reach: Reach, spread: bool = True) -> DataFrame:
    """Every measure of the same key around the matching week of the year before.

    Rows with nothing in reach a year before are left out. Without ``spread`` the
    features stay in one timeline per key, for ``combine_features``, which leaves them out.
    """
    if not spread:
        return _lines_of_years(weekly, calendar, keys, measures)
    distances = year_offsets(reach.year_left, reach.year_right)
    sliced = _slices(weekly, calendar, keys, measures, [], distances).where("exists(_y, e -> e IS NOT NULL)")
    return _spread(sliced, [*WEEK_KEYS, *keys], _looked_up(measures, [], distances))


def combine_features(by_week: DataFrame, by_year: DataFrame, keys: list[str],
                     measures: list[Measure] | None = None, reach: Reach | None = None) -> DataFrame:
    """Same-year rows with the prior-year features of the same week, where any.

    Features that are not spread yet, of these ``measures`` and ``reach``, are joined
    key by key, one row each, and spread then: timelines laid out by key are
    joined where they lie, and wide rows are neither shuffled nor sorted.
    """
    if measures is not None and reach is not None:
        return _combined_lines(by_week, by_year, keys, measures, reach)
    return by_week.join(by_year.drop("year", "week"), [*keys, "week_num"], "left").select(
        *by_week.columns, *[c for c in by_year.columns if c not in by_week.columns])


def _combined_lines(by_week: DataFrame, by_year: DataFrame, keys: list[str], measures: list[Measure],
                    reach: Reach) -> DataFrame:
    """``combine_features`` of timelines; a row comes as often as its week has prior-year rows."""
    weeks, years = week_offsets(reach.left, reach.right), year_offsets(reach.year_left, reach.year_right)
    # By week its rows' matching weeks: one, unless the week has several rows.
    sides = by_year.selectExpr(
        *keys, "_line AS _year_line", "_first AS _year_first", "filter(_rows, r -> r.week_num IS NOT NULL) AS _dated",
    ).selectExpr(*keys, "_year_line", "_year_first", "_dated", "array_distinct(_dated.week_num) AS _nums").selectExpr(
        *keys, "_year_line", "_year_first",
        "map_from_arrays(_nums, if(size(_nums) = size(_dated), transform(_dated, r -> array(r.prev_week_num)), "
        "transform(_nums, w -> transform(filter(_dated, r -> r.week_num = w), r -> r.prev_week_num)))) AS _matches")
    year_slice = ", ".join(_slice("_year_line", "_year_first", "p", years, "_y"))
    found = (f"filter(transform(try_element_at(_matches, e.week_num), p -> struct({year_slice})), "
             "s -> exists(s._y, y -> y IS NOT NULL))")
    fields = [f"e.{c} AS {c}" for c in dict.fromkeys([*WEEK_KEYS, *[m.column for m in measures]])]
    fields += [*_slice("_line", "_first", "e.week_num", weeks, "_w"), "s._y AS _y", "s._y_skip AS _y_skip"]
    # A row without any gets one empty entry.
    some = f"transform(array({found}), f -> if(size(f) > 0, f, array(get(f, 0))))[0]"
    rows = f"flatten(transform(_rows, e -> transform({some}, s -> struct({', '.join(fields)}))))"
    # A full join, as Spark would filter one side of a left join below its shuffle, and so shuffle twice what both sides
    # are made of. Keys of the year side alone have no rows and vanish.
    sliced = by_week.join(sides, keys, "full").selectExpr(*keys, f"inline({rows})")
    return _spread(sliced, [*WEEK_KEYS, *keys, *[m.column for m in measures]], _looked_up(measures, weeks, years))


def rollup_over_stores(features: DataFrame, measures: list[Measure]) -> DataFrame:
    """Features of an item over its stores: quantities add up, prices average."""
    priced = tuple(m.column for m in measures if "price" in m.column)
    values = [c for c in features.columns if c not in [*WEEK_KEYS, "store", "item"]]
    return features.groupBy(*WEEK_KEYS, "item").agg(
        *[F.expr(f"{'avg' if c.startswith(priced) else 'sum'}({c}) AS {c}") for c in values])


def _exception_spans(exceptions: DataFrame, reach: Reach) -> DataFrame:
    """Per (year, week_num) near an exception: which feature distances are hidden.

    Built from the dictionary alone, by listing the weeks around each exception;
    weeks out of reach of every exception hide nothing and are not listed.
    """
    this_year = exceptions.select("year", "week_num")
    last_year = exceptions.select((F.col("year") + 1).alias("year"), F.col("next_week_num").alias("week_num"))
    lists = (
        this_year.withColumn("this", F.lit(True)).unionByName(last_year.withColumn("this", F.lit(False)))
        .groupBy("year").agg(
            F.collect_set(F.when(F.col("this"), F.col("week_num"))).alias("this"),
            F.collect_set(F.when(~F.col("this"), F.col("week_num"))).alias("last"))
    )

    def around(weeks: DataFrame, left: int, right: int) -> DataFrame:
        near = F.sequence(F.col("week_num") - right, F.col("week_num") + left)
        return weeks.select("year", F.explode(near).alias("week_num"))

    near = around(this_year, reach.left, reach.right).unionByName(
        around(last_year, reach.year_left, reach.year_right)).distinct()
    week = F.col("week_num")
    spans = near.join(lists, "year").select(
        "year", "week_num",
        nearest_at_or_after(F.col("this"), week - reach.left).alias("p1"),
        nearest_at_or_before(F.col("this"), week).alias("p2"),
        nearest_at_or_before(F.col("this"), week + reach.right).alias("n1"),
        nearest_at_or_after(F.col("this"), week).alias("n2"),
        nearest_at_or_after(F.col("last"), week - reach.year_left).alias("yp1"),
        nearest_at_or_before(F.col("last"), week).alias("yp2"),
        nearest_at_or_before(F.col("last"), week + reach.year_right).alias("yn1"),
        nearest_at_or_after(F.col("last"), week).alias("yn2"),
    )

    def hidden(suffix: str, distance: int, low: str, high: str) -> str:
        return f"week_num + {distance} >= {low} AND week_num + {distance} <= {high} AS hide_{suffix}"

    return spans.selectExpr(
        "year", "week_num",
        *[hidden(x, d, *(("p1", "p2") if d < 0 else ("n2", "n1"))) for x, d in week_offsets(reach.left, reach.right)],
        *[hidden(x, d, *(("yp1", "yp2") if d <= 0 else ("yn2", "yn1")))
          for x, d in year_offsets(reach.year_left, reach.year_right)])


def mask_exceptions(features: DataFrame, exceptions: DataFrame, measures: list[Measure],
                    reach: Reach) -> DataFrame:
    """Drop exception weeks and blank features that reach into their span.

    Looking back, the span runs from the earliest exception week of the year
    within reach to the latest one not after the row; looking ahead, from the
    earliest one not before the row to the latest within reach. All features in
    between are blanked, not just the exception weeks. Prior-year features use
    the exceptions of the year before at their week of the following year.

    ``exceptions`` (year, week_num, next_week_num) has at most one row per
    calendar week, and what is made of it at most some tens, so both are
    broadcast and the wide rows stay in place.
    """
    spans = F.broadcast(_exception_spans(exceptions, reach))
    dropped = F.broadcast(exceptions.select("week_num").distinct())
    rows = features.join(dropped, "week_num", "left_anti").join(spans, ["year", "week_num"], "left")
    hides = {f"{m.week}_{x}": x for x, _ in week_offsets(reach.left, reach.right) for m in measures}
    hides |= {f"{m.year}_{x}": x for x, _ in year_offsets(reach.year_left, reach.year_right) for m in measures}
    return rows.selectExpr(*[
        f"if(hide_{hides[c]}, NULL, {c}) AS {c}" if c in hides else c for c in features.columns])
