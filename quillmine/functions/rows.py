"""Rows as one column, so that an operator's own names cannot clash with a table's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column's name as Spark reads it, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def packed(columns: list[str], name: str = "row") -> Column:
    return F.struct(*[F.col(quoted(c)).alias(c) for c in columns]).alias(name)


def unpacked(columns: list[str], name: str = "row") -> list[Column]:
    """packed() undone."""
    return [F.col(name).getField(c).alias(c) for c in columns]
