"""Small column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Layouts tried, in order, when a timestamp arrives as text.
TIMESTAMP_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "yyyy-MM-dd",
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
)

# Spark type wide enough for an unsigned number of so many bits.
UNSIGNED_TYPES = {8: "short", 16: "int", 32: "bigint"}


def no_value(value: Column) -> Column:
    """True for NULL, NaN and zero, which all mean "nothing recorded"."""
    number = value.cast("double")
    return number.isNull() | F.isnan(number) | (number == 0)


def valid_price(price: Column) -> Column:
    """The price if it is a positive number, else NULL."""
    return F.when(~no_value(price) & (price > 0), price)


def unsigned_or_null(text: Column, bits: int) -> Column:
    """Text as an unsigned integer of ``bits`` bits; NULL if it is not one."""
    number = F.when(text.rlike("^[0-9]+$"), text).try_cast("bigint")
    return F.when(number <= 2**bits - 1, number).cast(UNSIGNED_TYPES[bits])


def int_or_zero(text: Column) -> Column:
    """Text as a 32-bit integer; 0 if it is not one."""
    number = F.when(text.rlike("^-?[0-9]+$"), text).try_cast("int")
    return F.coalesce(number, F.lit(0))


def parse_timestamp(text: Column, layouts: Iterable[str] = TIMESTAMP_LAYOUTS) -> Column:
    """Text as a timestamp by the first layout that fits; NULL if none does.

    Nine or ten digits are seconds since 1970.
    """
    seconds = F.when(text.rlike("^[0-9]{9,10}$"), text).try_cast("bigint")
    return F.coalesce(F.timestamp_seconds(seconds), *[F.try_to_timestamp(text, F.lit(layout)) for layout in layouts])


def natural_key(*parts: Column) -> Column:
    """Parts as text joined by '|'; NULL as soon as one part is NULL."""
    texts = [part.cast("string") for part in parts]
    return reduce(lambda left, right: F.concat(left, F.lit("|"), right), texts)


def key_prefix(key: Column, levels: int) -> Column:
    """First ``levels`` parts of a key such as 'dept|class|subclass'."""
    return F.substring_index(key, "|", levels)


def true_flag(flag: Column) -> Column:
    """'t' becomes '1', everything else, also NULL, becomes '0'."""
    return F.when(flag == "t", F.lit("1")).otherwise(F.lit("0"))


def mean_of(total: Column, count: Column) -> Column:
    """Quotient that is NULL, not an error, for a zero count."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def wall_clock(value: dt.datetime, like: DataType) -> Column:
    """A moment of the session's wall clock as a literal of a column's type."""
    return F.lit(value.isoformat(sep=" ")).cast(like)
