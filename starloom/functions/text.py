"""Text and position expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bare(c: Column) -> Column:
    """Text without blanks at its end; null is the empty text."""
    return F.rtrim(F.coalesce(c, F.lit("")))


def hex_position(c: Column, digits: int = 20) -> Column:
    """A log position as lower-case hex of fixed width, so that text order is number order.

    Prefix 0x, separators and letter case don't matter; null or no digits gives null.
    """
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "^0x", ""), "[^0-9a-f]", "")
    plain = F.regexp_replace(plain, "^0+(?=.)", "")
    return F.when(F.length(plain) > 0, F.lpad(plain, digits, "0"))


def next_position(c: Column) -> Column:
    """The position after one of 20 hex digits; that after the last one wraps to zero."""
    half = lambda x: F.conv(x, 16, 10).cast("bigint")
    low = half(F.right(c, F.lit(10))) + 1
    carry = F.floor(low / F.lit(1 << 40)).cast("bigint")
    high = F.pmod(half(F.left(c, F.lit(10))) + carry, F.lit(1 << 40))
    digits = lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")
    return F.concat(digits(high), digits(F.pmod(low, F.lit(1 << 40))))


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone that means UTC, with floor towards the past."""
    return F.floor(epoch_micros(c) / F.lit(1_000_000)).cast("bigint")


def epoch_micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))
