"""Small numeric and text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VOXEL_BITS = 21


def voxel_index(x: Column, size: float) -> Column:
    """floor(x / size) in single precision: Spark divides in double, so the quotient is cast back."""
    return F.floor((x.cast("float") / F.lit(size).cast("float")).cast("float")).cast("long")


def pack_key(kx: Column, ky: Column, kz: Column) -> Column:
    """Three cells in 63 bits, 21 of each in two's complement: cells beyond 2 ** 20 wrap round."""
    mask = (1 << VOXEL_BITS) - 1
    return F.shiftleft(kx.bitwiseAND(mask), 42).bitwiseOR(F.shiftleft(ky.bitwiseAND(mask), 21)).bitwiseOR(kz.bitwiseAND(mask))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def safe(n: Column) -> Column:
    """A norm to divide by: one where it is zero."""
    return F.when(n == 0, 1.0).otherwise(n)


def split_ns(t: Column) -> tuple[Column, Column]:
    """Nanoseconds as whole seconds, rounded down, and the rest."""
    rest = F.pmod(t, F.lit(1_000_000_000))
    return ((t - rest) / 1_000_000_000).cast("long"), rest


def cross2(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """The signed area of two plane vectors: positive where b lies left of a."""
    return ax * by - ay * bx


def cross3(a: tuple, b: tuple) -> tuple[Column, Column, Column]:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]
