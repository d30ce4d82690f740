"""Null replacement, lenient casts and small column rules shared by readers and writers."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def zero(type_: T.DataType, narrow_dates: bool = False) -> Column:
    """What a column that allows no null holds instead: 0, the empty text, false, 1970-01-01 00:00:00 or, for dates, 1900-01-01.

    narrow_dates: the dates go to a type that begins in 1970, where 1970-01-01 stands.
    """
    if isinstance(type_, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit("")
    if isinstance(type_, T.BooleanType):
        return F.lit(False)
    if isinstance(type_, T.DateType):
        return F.lit(datetime.date(1970 if narrow_dates else 1900, 1, 1))
    if isinstance(type_, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(type_)
    if isinstance(type_, T.NumericType):
        return F.lit(0).cast(type_)
    return F.lit(None).cast(type_)


def coerce(c: Column, type_: T.DataType, nullable: bool = False) -> Column:
    """Cast without failing: what can't be read is null, or the zero value where null isn't allowed."""
    out = c.try_cast(type_)
    return out if nullable else F.coalesce(out, zero(type_))


def fill_zeros(df: DataFrame, nullable: tuple[str, ...] = ()) -> DataFrame:
    """df without nulls but in the named columns; columns keep order and type."""
    return df.select(*(F.col(f.name) if f.name in nullable else F.coalesce(f.name, zero(f.dataType)).alias(f.name) for f in df.schema.fields))


def normalise(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Texts without blanks at their end and without null; other columns stay."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.coalesce(F.rtrim(c), F.lit("")) for c in names})


def date_key(c: Column) -> Column:
    """yyyyMMdd as a number; 0 without a date."""
    return F.coalesce(F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c), F.lit(0)).cast("int")


def years_between(a: Column, b: Column) -> Column:
    """Year boundaries crossed from a to b."""
    return F.year(b) - F.year(a)


def any_differs(pairs: list[tuple[Column, Column]]) -> Column:
    """Whether any pair differs; null equals null."""
    out = F.lit(False)
    for a, b in pairs:
        out = out | ~a.eqNullSafe(b)
    return out


def one_of(c: Column, wanted: list | None) -> Column:
    """A report filter: no filter for None or an empty list; null matches only no filter."""
    return c.isin(wanted) if wanted else F.lit(True)


def net_amount(price: Column, quantity: Column, discount: Column) -> Column:
    """price x quantity x (1 - discount), rounded half up to four digits; the discount is read to four digits."""
    rate = F.round(discount.cast("double"), 4).cast("decimal(9,4)")
    return (price.cast("decimal(15,4)") * quantity.cast("decimal(9,0)") * (F.lit(1) - rate)).cast("decimal(19,4)")
