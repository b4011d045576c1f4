"""Week arithmetic: Monday weeks counted from the epoch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_number(day: Column) -> Column:
    """Ordinal of the Monday week holding ``day``; 1970-01-05 starts week 1."""
    return F.floor((F.unix_date(day) + 3) / 7).cast("int")


def week_year(day: Column) -> Column:
    """Year of the Monday that starts the week of ``day``."""
    return F.year(F.trunc(day, "week"))


def year_end_week(year: Column) -> Column:
    """Ordinal of the week holding 31 December of ``year``."""
    return week_number(F.make_date(year, F.lit(12), F.lit(31)))


def week_in_year(day: Column) -> Column:
    """Week of ``day`` counted from the last week of the year before."""
    return week_number(day) - year_end_week(week_year(day) - 1)


def week_columns(day: Column) -> list[Column]:
    """The three week columns every weekly table carries."""
    return [
        week_year(day).alias("year"),
        week_in_year(day).alias("week"),
        week_number(day).alias("week_num"),
    ]


WEEK_KEYS = ["year", "week", "week_num"]
