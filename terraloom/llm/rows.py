"""Whole rows carried through an operator as one column, so that no name of theirs can clash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_struct(docs: DataFrame, but: str) -> Column:
    """All columns but one, by place."""
    return F.struct(F.lit(0).alias("f"), *[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(docs.columns) if c != but])


def as_columns(docs: DataFrame, but: str, new: Column, row: str = "row", kept: Sequence[str] | None = None) -> list[Column]:
    """The columns of docs (those kept) from the struct, with a new one in the other's place."""
    return [new.alias(c) if c == but else F.col(row).getField(f"f{i}").alias(c) for i, c in enumerate(docs.columns) if kept is None or c in kept]
