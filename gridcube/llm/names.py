"""Names of the caller's columns, kept apart from those that an operator adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_place(rows: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``rows`` with its columns named by their place (_0, _1, ...), and those
    names by the old ones. Extra columns may then have any name."""
    places = [f"_{i}" for i in range(len(rows.columns))]
    return rows.toDF(*places), dict(zip(rows.columns, places))


def named(at: dict[str, str]) -> list[Column]:
    """The columns of ``by_place`` under their old names."""
    return [F.col(place).alias(name) for name, place in at.items()]
