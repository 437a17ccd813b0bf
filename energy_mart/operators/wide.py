"""Pairwise correlations of very many columns, by blocks of masked product sums.

One expression per pair of columns stops compiling at some hundred columns. Here a row is two
arrays, its values (null as 0) and which of them are given; a task adds up six products of
matrices per pair of column blocks, and only these sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energy_mart.functions.numbers import nan_to_null
from energy_mart.operators.profile import numeric_columns
from energy_mart.operators.project import quoted

#: Columns per block: a task holds six sums for each pair of two blocks.
BLOCK = 256
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _centres(df: DataFrame, names: Sequence[str], block: int) -> dict[str, float]:
    """Mean of each column, to keep the sums of squares exact; a job per block of columns.

    An aggregate of some hundred columns is not compiled, so columns are added up as one array too.
    """
    out: dict[str, float] = {}
    for start in range(0, len(names), block):
        part = names[start : start + block]
        m = len(part)

        def add(batches: Iterator[pa.RecordBatch], m: int = m) -> Iterator[pa.RecordBatch]:
            n, total = np.zeros(m), np.zeros(m)
            for batch in batches:
                flat = batch.column(0).flatten()
                n += np.asarray(flat.is_valid()).reshape(-1, m).sum(0)
                total += np.asarray(flat.fill_null(0.0)).reshape(-1, m).sum(0)
            columns = [pa.array(np.arange(m, dtype=np.int32)), pa.array(n), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "total"])

        cells = df.select(F.array(*[F.col(quoted(c)) for c in part]).alias("v"))
        sums = cells.mapInArrow(add, "i int, n double, total double").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        found = {r["i"]: r["total"] / r["n"] for r in sums.filter("n > 0").collect()}  # a row per column
        out |= {c: found.get(i, 0.0) for i, c in enumerate(part)}
    return out


def _products(df: DataFrame, left: Sequence[str], right: Sequence[str], centres: dict[str, float]) -> DataFrame:
    """(i, j, sums): summed over rows, for each column of ``left`` against each of ``right``."""
    names = [*left, *right]
    cells = F.array(*[F.col(quoted(c)) - F.lit(centres[c]) for c in names]).alias("v")
    k, m = len(left), len(names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, m - k))
        for batch in batches:
            flat = batch.column(0).flatten()
            given = np.asarray(flat.is_valid()).reshape(-1, m).astype(float)
            value = np.asarray(flat.fill_null(0.0)).reshape(-1, m)
            mx, my, x, y = given[:, :k], given[:, k:], value[:, :k], value[:, k:]
            total += np.stack([mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y])
        rows = [pa.array(np.arange(k, dtype=np.int32))]
        offsets = pa.array(np.arange(0, k * (m - k) + 1, m - k, dtype=np.int32))
        rows += [pa.ListArray.from_arrays(offsets, pa.array(part.ravel())) for part in total]
        yield pa.RecordBatch.from_arrays(rows, names=["i", *_SUMS])

    schema = "i int, " + ", ".join(f"{s} array<double>" for s in _SUMS)
    sums = df.select(cells).mapInArrow(add, schema)
    cells = sums.select("i", F.posexplode(F.arrays_zip(*_SUMS)).alias("j", "s"))
    return cells.groupBy("i", "j").agg(*[F.sum(f"s.{s}").alias(s) for s in _SUMS])


def wide_correlations(df: DataFrame, names: Sequence[str] | None = None, block: int = BLOCK) -> DataFrame:
    """Rows (a, b, n, corr) for every two columns a before b: rows that have both, and their correlation.

    Null, NaN and columns without spread in common give a null correlation. Equals ``correlations`` up to rounding.
    """
    names = list(names or numeric_columns(df))
    rows = df.select(*[nan_to_null(F.col(quoted(c)).cast("double")).alias(c) for c in names])
    centres = _centres(rows, names, block)
    blocks = [names[start : start + block] for start in range(0, len(names), block)]
    out = None
    for at, left in enumerate(blocks):
        for right in blocks[at:]:
            a, b = F.array(*[F.lit(c) for c in left]), F.array(*[F.lit(c) for c in right])
            part = _products(rows, left, right, centres)
            if left is right:
                part = part.filter("i < j")
            named = part.select(F.get(a, F.col("i")).alias("a"), F.get(b, F.col("j")).alias("b"), *_SUMS)
            out = named if out is None else out.unionAll(named)
    n = F.col("n")
    across = n * F.col("sxy") - F.col("sx") * F.col("sy")
    spread = lambda s, ss: n * F.col(ss) - F.col(s) * F.col(s)
    # Rounding leaves a little spread where there is none.
    some = (spread("sx", "sxx") > 1e-12 * n * F.col("sxx")) & (spread("sy", "syy") > 1e-12 * n * F.col("syy"))
    corr = F.when(some, across / F.sqrt(spread("sx", "sxx") * spread("sy", "syy")))
    return out.select("a", "b", n.cast("long").alias("n"), corr.alias("corr"))
