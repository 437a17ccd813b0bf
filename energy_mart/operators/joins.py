"""Joins with nulls as equal keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def join_null_safe(
    left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal names, null equal to null, keeping the left side's key columns."""
    renamed = right.withColumnsRenamed({n: f"__{n}" for n in names})
    on = F.lit(True)
    for name in names:
        on = on & F.col(_quoted(name)).eqNullSafe(F.col(_quoted(f"__{name}")))
    return left.join(renamed, on, how).drop(*[f"__{n}" for n in names])
