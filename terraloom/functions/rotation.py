"""Rotations as nine columns, row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Matrix = list[list[Column]]
Vector = tuple[Column, Column, Column]


def product(a: Matrix, b: Matrix) -> Matrix:
    return [[a[i][0] * b[0][j] + a[i][1] * b[1][j] + a[i][2] * b[2][j] for j in range(3)] for i in range(3)]


def compose(outer: Matrix, outer_t: Vector, inner: Matrix, inner_t: Vector) -> tuple[Matrix, Vector]:
    """The rotation and shift of doing the inner transform, then the outer one."""
    return product(outer, inner), apply(outer, inner_t, outer_t)


def about(axis: int, degrees: Column) -> Matrix:
    """Rotation about axis 0 (x), 1 (y) or 2 (z)."""
    c, s, o, z = F.cos(F.radians(degrees)), F.sin(F.radians(degrees)), F.lit(1.0), F.lit(0.0)
    return {0: [[o, z, z], [z, c, -s], [z, s, c]], 1: [[c, z, s], [z, o, z], [-s, z, c]], 2: [[c, -s, z], [s, c, z], [z, z, o]]}[axis]


def body_to_ned(roll: Column, pitch: Column, azimuth: Column) -> Matrix:
    """Front-right-down body to north-east-down: z(azimuth) * y(pitch) * x(roll)."""
    return product(product(about(2, azimuth), about(1, pitch)), about(0, roll))


def body_to_enu(roll: Column, pitch: Column, azimuth: Column) -> Matrix:
    """Front-left-up body to east-north-up: rows swap, the third and the last two columns change sign."""
    n, e, d = body_to_ned(roll, pitch, azimuth)
    return [[r[0], -r[1], -r[2]] for r in (e, n, [-x for x in d])]


def from_quaternion(x: Column, y: Column, z: Column, w: Column) -> Matrix:
    """Without normalisation."""
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ]


def apply(r: Matrix, p: Vector, t: Vector | None = None) -> Vector:
    """r * p + t."""
    out = [r[i][0] * p[0] + r[i][1] * p[1] + r[i][2] * p[2] for i in range(3)]
    return tuple(x + s for x, s in zip(out, t)) if t else tuple(out)


def columns(r: Matrix, prefix: str = "r") -> list[Column]:
    """r11 to r33."""
    return [r[i][j].alias(f"{prefix}{i + 1}{j + 1}") for i in range(3) for j in range(3)]


def read(prefix: str = "r") -> Matrix:
    return [[F.col(f"{prefix}{i + 1}{j + 1}") for j in range(3)] for i in range(3)]
