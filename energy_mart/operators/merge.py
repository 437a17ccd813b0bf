"""Deterministic first-wins, insert-if-absent and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.operators.project import quoted


def first_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by all other columns, nulls first.

    A minimum over a struct combines before the shuffle, so a key with very many rows
    costs no more than one with few.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*[quoted(k) for k in keys]).distinct()
    picked = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(
        F.min(F.struct(*[F.col(quoted(c)) for c in others])).alias("__row")
    )
    return picked.select(
        *[F.col(quoted(c)) if c in keys else F.col("__row")[c].alias(c) for c in df.columns]
    )


def absent_rows(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the target yet."""
    return df.join(target.select(*keys), list(keys), "left_anti").select(*df.columns)


def conflicting_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys carried by more than one distinct row."""
    return df.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    kept: Sequence[str] = (),
    stamp: tuple[str, Column] | None = None,
) -> DataFrame:
    """Target with source rows updated or added; ``kept`` columns stay the target's own.

    A null in the source overwrites too. ``source`` must be unique on ``keys``.
    """
    s = source.select(
        *[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("s_here")
    )
    on = [target[k] == s[f"s_{k}"] for k in keys]
    joined = target.join(s, on, "full_outer")
    out = []
    for name in target.columns:
        if stamp and name == stamp[0]:
            value = F.when(F.col("s_here"), stamp[1]).otherwise(target[name])
        elif name in kept:
            value = F.coalesce(target[name], F.col(f"s_{name}")) if name in source.columns else target[name]
        elif name in source.columns:
            value = F.when(F.col("s_here"), F.col(f"s_{name}")).otherwise(target[name])
        else:
            value = target[name]
        out.append(value.alias(name))
    return joined.select(*out)
