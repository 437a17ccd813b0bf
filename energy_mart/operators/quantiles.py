"""Exact quantiles (linear interpolation) with bounded memory per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.functions.numbers import nan_to_null
from energy_mart.operators.joins import join_null_safe
from energy_mart.operators.numbering import running_total
from energy_mart.operators.project import quoted
from energy_mart.session import materialise

ACCURACY = 10_000


def _double(name: str):
    return nan_to_null(F.col(quoted(name)).cast("double"))


def first_scan(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    extra: Sequence[Column] = (),
    margin: float = 2 / ACCURACY,
) -> DataFrame:
    """One settled row per group: size, fixed-size sketches around each quantile, extras."""
    edges = [min(max(p + side, 0.0), 1.0) for p in sorted(probs) for side in (-margin, margin)]
    wanted = F.array(*[F.lit(e) for e in edges])
    sketches = [
        F.percentile_approx(_double(c), wanted, F.lit(ACCURACY)).alias(f"__edges{i}")
        for i, c in enumerate(cols)
    ]
    return materialise(
        df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"), *sketches, *extra)
    )


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    first: DataFrame | None = None,
) -> DataFrame:
    """Rows (*by, column, q) with ``q`` the values at ``probs``; null without any value.

    Two scans, whatever the size of a group. The first counts the groups and sketches, the
    second selects by rank around the sketches (see ``_selected``), which is exact.
    """
    probs = sorted(probs)
    first = first_scan(df, cols, probs, by) if first is None else first
    keys = [*by, "column"]
    every = _stacked(first, cols, by, lambda i: F.lit(None).cast("array<double>")).drop("q")
    return join_null_safe(every, _selected(df, cols, probs, by, first), keys, "left")


def _stacked(wide, cols, by, value):
    entries = [
        F.struct(F.lit(c).alias("column"), value(i).alias("q")) for i, c in enumerate(cols)
    ]
    return wide.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.column", "e.q")


def _selected(df, cols, probs, by, first):
    """Exact ranks of the few values near the sketched quantiles.

    Values inside a bracket are counted by value, all others only by the gap they fall into,
    so the shuffle carries partial counts. Ranks come from a distributed running total. When
    a sketch missed, the bracket is widened; the last try keeps every value.
    """
    keys = [*by, "column"]
    for sketches in (
        lambda: first, lambda: first_scan(df, cols, probs, by, margin=0.05), lambda: None
    ):
        counts = _compressed(df, cols, probs, by, sketches())
        ranked = materialise(running_total(counts, ["low"], "n", "upto", by=keys))
        picked = materialise(_at_ranks(ranked, probs, keys))
        if picked.filter("missed").isEmpty():
            return picked.select(*keys, "q")
    raise AssertionError("every value was kept, so no rank can be missed")


def _compressed(df, cols, probs, by, sketches):
    """Rows (*by, column, low, high, n): counted values and counted gaps."""
    entries = [F.struct(F.lit(c).alias("column"), _double(c).alias("x")) for c in cols]
    cells = df.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.column", "e.x")
    cells = cells.filter(F.col("x").isNotNull())
    if sketches is None:
        held = cells.withColumn("held", F.col("x")).withColumn("gap", F.lit(0))
    else:
        brackets = _stacked(sketches, cols, by, lambda i: F.col(f"__edges{i}"))
        joined = join_null_safe(cells, materialise(brackets), [*by, "column"])
        x, q = F.col("x"), F.col("q")
        inside, gap = F.lit(False), F.lit(0)
        for i in range(len(probs)):
            inside = inside | x.between(q[2 * i], q[2 * i + 1])
            gap = gap + F.when(q[2 * i + 1] < x, 1).otherwise(0)
        held = joined.select(
            *by, "column", "x",
            F.when(inside, x).alias("held"),
            F.when(inside, -1).otherwise(gap).alias("gap"),
        )
    counts = held.groupBy(*by, "column", "gap", "held").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("n")
    )
    return counts.drop("gap", "held")


def _at_ranks(ranked, probs, keys):
    totals = ranked.groupBy(*keys).agg(F.max("upto").alias("total"))
    rows = join_null_safe(ranked, materialise(totals), keys)
    first, aggregates = F.col("upto") - F.col("n"), []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("total") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (first <= rank) & (rank < F.col("upto"))
            aggregates += [
                F.max(F.when(here, F.col("low"))).alias(f"{side}{i}"),
                F.max(F.when(here, F.col("low") != F.col("high"))).alias(f"{side}{i}_missed"),
            ]
        aggregates.append(F.max(place - F.floor(place)).alias(f"part{i}"))
    picked = rows.groupBy(*keys).agg(*aggregates)
    values = [
        F.col(f"lo{i}") + F.col(f"part{i}") * (F.col(f"hi{i}") - F.col(f"lo{i}"))
        for i in range(len(probs))
    ]
    missed = F.lit(False)
    for i in range(len(probs)):
        missed = missed | F.col(f"lo{i}_missed") | F.col(f"hi{i}_missed")
    return picked.select(*keys, F.array(*values).alias("q"), missed.alias("missed"))
