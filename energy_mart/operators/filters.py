"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTAL_ROW = "TOTAL NACIONAL"


def complete_rows(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null in the chosen columns (all by default)."""
    return df.dropna("any", subset=list(names) if names else None)


def without_total(df: DataFrame, name: str, total: str = TOTAL_ROW) -> DataFrame:
    """Drop the published total row; a null name goes too."""
    return df.filter(F.col(name) != total)


def outside_range(df: DataFrame, name: str, low: float, high: float) -> DataFrame:
    """Rows at or beyond either end."""
    return df.filter((F.col(name) <= low) | (F.col(name) >= high))


def by_date_parts(
    df: DataFrame,
    name: str,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
) -> DataFrame:
    """Rows of a year, month and/or day; the year is a range, so it reaches the scan."""
    out = df
    if year:
        c = F.col(name)
        out = out.filter((c >= F.lit(date(year, 1, 1))) & (c < F.lit(date(year + 1, 1, 1))))
    if month:
        out = out.filter(F.month(name) == month)
    if day:
        out = out.filter(F.dayofmonth(name) == day)
    return out


def chosen(df: DataFrame, **choices: Sequence) -> DataFrame:
    """Rows whose columns are all in the chosen lists; a missing list chooses everything."""
    out = df
    for name, values in choices.items():
        if values is not None:
            out = out.filter(F.col(name).isin(*values))
    return out
