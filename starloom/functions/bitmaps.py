"""Compressed bitmaps over ranges of 2^15 keys.

Spark's bitmap_construct_agg builds the plain bitmap of a range, combined before the shuffle.
Packed, a range is stored in the smallest of three containers, told by the first byte:
A the set bits as 16-bit numbers, R runs as (first, length - 1) pairs, B the 4 KB bitmap itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_BITS = 15
RANGE = 1 << RANGE_BITS


def range_of(key: Column) -> Column:
    """The key range of an integer key; negative keys have ranges of their own."""
    return F.shiftright(key.cast("bigint"), RANGE_BITS)


def bit_of(key: Column) -> Column:
    return F.pmod(key.cast("bigint"), F.lit(RANGE))


def key_of(range_: Column, bit: Column) -> Column:
    return F.shiftleft(range_, RANGE_BITS) + bit


def bits(packed: bytes | None) -> np.ndarray:
    """The set bits, ascending."""
    if not packed:
        return np.empty(0, np.int64)
    kind, body = packed[:1], packed[1:]
    if kind == b"A":
        return np.frombuffer(body, "<u2").astype(np.int64)
    if kind == b"R":
        runs = np.frombuffer(body, "<u2").astype(np.int64).reshape(-1, 2)
        return np.concatenate([np.arange(a, a + n + 1) for a, n in runs])
    return np.flatnonzero(np.unpackbits(np.frombuffer(body, np.uint8), bitorder="little"))


def unpack(bitmap: bytes) -> np.ndarray:
    """The set bits, ascending, of what bitmap_construct_agg returns."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))


def plain(packed: bytes | None) -> np.ndarray:
    out = np.zeros(RANGE, bool)
    out[bits(packed)] = True
    return out


def pack(at: np.ndarray) -> bytes:
    """at: the set bits, ascending and unique."""
    if not len(at):
        return b"A"
    cuts = np.flatnonzero(np.diff(at) != 1) + 1
    first = at[np.concatenate(([0], cuts))]
    last = at[np.concatenate((cuts - 1, [len(at) - 1]))]
    size = {b"A": 2 * len(at), b"R": 4 * len(first), b"B": RANGE // 8}
    kind = min(size, key=lambda k: size[k])
    if kind == b"A":
        return kind + at.astype("<u2").tobytes()
    if kind == b"R":
        return kind + np.stack((first, last - first), 1).astype("<u2").tobytes()
    full = np.zeros(RANGE, np.uint8)
    full[at] = 1
    return kind + np.packbits(full, bitorder="little").tobytes()


def and_not(a: bytes | None, b: bytes | None) -> np.ndarray:
    """Bits of a that are not in b."""
    at = bits(a)
    return at[~plain(b)[at]] if b and len(at) else at


def and_(a: bytes | None, b: bytes | None) -> np.ndarray:
    at = bits(a)
    return at[plain(b)[at]] if b and len(at) else at[:0]


@F.pandas_udf(T.BinaryType())
def compress(bitmap: pd.Series) -> pd.Series:
    """A packed range from what bitmap_construct_agg returns."""
    return bitmap.map(lambda x: pack(unpack(x)))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def surviving(a: pd.Series, b: pd.Series) -> pd.Series:
    """Bits of a AND-NOT b."""
    return pd.Series([and_not(x, y) for x, y in zip(a, b, strict=True)])


def bitmap_of(key: str) -> Column:
    """Aggregate: the plain bitmap of the keys of one range."""
    return F.bitmap_construct_agg(bit_of(F.col(key)))
