"""Report aggregates: matrices, shares, comparisons, reconciliation, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.functions.numbers import percent_change
from energy_mart.functions.text import MONTH_LABELS

OTHERS = "Otros"


def total(name: str) -> Column:
    """Sum where nothing at all adds up to zero."""
    return F.coalesce(F.sum(name), F.lit(0))


def _columns(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def month_matrix(
    df: DataFrame,
    row: str | Sequence[str],
    value: str,
    month: str = "mes",
    labels: Sequence[str] = MONTH_LABELS,
) -> DataFrame:
    """Mean of ``value`` by row and month, twelve fixed month columns."""
    out = df.groupBy(*_columns(row)).pivot(month, list(range(1, 13))).agg(F.avg(value))
    return out.withColumnsRenamed({str(i + 1): label for i, label in enumerate(labels)})


def matrix(
    df: DataFrame, row: str, column: str, values: Sequence[str], cell: Column, fill: float | None = None
) -> DataFrame:
    """Pivot over fixed column values, optionally filling empty cells."""
    out = df.groupBy(row).pivot(column, list(values)).agg(cell)
    return out if fill is None else out.fillna(fill, subset=list(values))


def share_of_total(df: DataFrame, value: str, out: str = "share_pct") -> DataFrame:
    """Percent of the grand total, taken as a scalar subquery, not a one-task window."""
    grand = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, F.try_divide(F.col(value) * F.lit(100.0), grand))


def top_rows(df: DataFrame, value: str, key: str | Sequence[str], n: int = 5) -> DataFrame:
    """First n by value, descending; ties by key."""
    return df.orderBy(F.col(value).desc_nulls_last(), *_columns(key)).limit(n)


def top_and_others(
    df: DataFrame, key: str, value: str, n: int = 5, others: str = OTHERS
) -> DataFrame:
    """Sums of the n largest groups, and one row for all the rest."""
    sums = df.filter(F.col(key).isNotNull()).groupBy(key).agg(total(value).alias(value))
    top = top_rows(sums, value, key, n).select(F.col(key).alias("__top"))
    # n rows at most.
    named = sums.join(F.broadcast(top), F.col(key) == F.col("__top"), "left")
    label = F.coalesce("__top", F.lit(others)).alias(key)
    return named.groupBy(label).agg(F.sum(value).alias(value))


def compare_slices(
    df: DataFrame, value: str, first: Column, second: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Means of two slices in one pass and the change from the first to the second."""
    means = df.groupBy(*by).agg(
        F.avg(F.when(first, F.col(value))).alias("mean_first"),
        F.avg(F.when(second, F.col(value))).alias("mean_second"),
    )
    change = percent_change(F.col("mean_second"), F.col("mean_first"))
    return means.withColumn("change_pct", change)


def reconcile_totals(
    df: DataFrame,
    is_total: Column,
    value: str,
    by: Sequence[str],
) -> DataFrame:
    """Published total against the sum of its parts, for keys that have both.

    Columns: parts, published, difference, difference_millions, difference_pct.
    """
    rows = df.filter(F.col(value).isNotNull())
    for name in by:
        rows = rows.filter(F.col(name).isNotNull())
    sums = rows.groupBy(*by).agg(
        F.sum(F.when(~is_total, F.col(value))).alias("parts"),
        F.sum(F.when(is_total, F.col(value))).alias("published"),
    )
    difference = F.col("published") - F.col("parts")
    return (
        sums.filter(F.col("parts").isNotNull() & F.col("published").isNotNull())
        .withColumn("difference", difference)
        .withColumn("difference_millions", F.round(F.col("difference") / 1e6, 2))
        .withColumn(
            "difference_pct", F.round(F.try_divide("difference", "published") * 100, 2)
        )
    )


def mean_of_means(df: DataFrame, by: str | Sequence[str], value: str) -> DataFrame:
    """Mean of the group means (not the mean of all rows)."""
    means = df.groupBy(*_columns(by)).agg(F.avg(value).alias("mean"))
    return means.agg(F.avg("mean").alias("mean_of_means"))


def linear_trend(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line over complete pairs: slope, intercept, corr, n and the x range."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.corr(x, y).alias("corr"),
        F.count(F.lit(1)).alias("n"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
    )


def trend_points(df: DataFrame, x: str, y: str, by: Sequence[str] = (), points: int = 100):
    """Rows (*by, point, x, y) evenly spaced on the trend line."""
    line = linear_trend(df, x, y, by)
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    out = line.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    out = out.withColumn("x", F.col("x_min") + F.col("point") * step)
    return out.select(*by, "point", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y"))
