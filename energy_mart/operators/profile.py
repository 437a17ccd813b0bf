"""Profiling and exploration: every figure of a frame in one pass where possible."""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energy_mart.functions.numbers import nan_to_null
from energy_mart.operators.joins import join_null_safe
from energy_mart.operators.project import keep_existing, numeric_columns, quoted
from energy_mart.operators.quantiles import exact_quantiles, first_scan
from energy_mart.session import materialise

IQR_FACTOR = 1.5


def _col(name: str) -> Column:
    return F.col(quoted(name))


def _rows(wide: DataFrame, entries: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Array of structs to rows."""
    return wide.select(*keep, F.explode(F.array(*entries)).alias("e")).select(*keep, "e.*")


def _missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return _col(name).isNull() | F.isnan(_col(name))
    return _col(name).isNull()


def _zero(df: DataFrame, name: str) -> Column | None:
    """Numeric zero or boolean false; text never counts."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return ~_col(name)
    return _col(name) == 0 if isinstance(kind, T.NumericType) else None


def dataset_metrics(df: DataFrame) -> DataFrame:
    """One row: rows, columns, null_pct (null for an empty frame), zeros."""
    nulls, zeros = F.lit(0), F.lit(0)
    for name in df.columns:
        nulls = nulls + F.count_if(_missing(df, name))
        zero = _zero(df, name)
        if zero is not None:
            zeros = zeros + F.count_if(zero)
    width = len(df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"), zeros.alias("zeros"))
    cells = (F.col("rows") * width).cast("double")
    return wide.select(
        "rows",
        F.lit(width).alias("columns"),
        F.try_divide(F.col("nulls") * F.lit(100.0), cells).alias("null_pct"),
        "zeros",
    )


def null_counts(df: DataFrame, keep: str = "some") -> DataFrame:
    """Rows (column, nulls, rows); ``keep`` is some (> 0), none (== 0) or all."""
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(df.columns)
    ]
    out = _rows(wide, entries, ["rows"]).select("column", "nulls", "rows")
    if keep == "some":
        return out.filter("nulls > 0")
    if keep == "none":
        return out.filter("nulls = 0")
    return out


def null_shares(df: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Columns with nulls, their percentage, and whether it passes the threshold."""
    share = F.try_divide(F.col("nulls") * F.lit(100.0), F.col("rows").cast("double"))
    return (
        null_counts(df)
        .select("column", "nulls", share.alias("null_pct"))
        .withColumn("over_threshold", F.col("null_pct") > threshold)
        .orderBy("null_pct", "column")
    )


def complete_columns(df: DataFrame) -> list[str]:
    """Names of the columns without nulls, in frame order (one small action)."""
    names = {r["column"] for r in null_counts(df, "none").collect()}
    return [c for c in df.columns if c in names]


def keep_complete(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Wanted columns that hold no null."""
    full = set(complete_columns(keep_existing(df, wanted)))
    return keep_existing(df, [c for c in wanted if c in full])


def distinct_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows (column, value, n): every distinct value, null included; NaN is missing, thus null."""
    def text(name: str) -> Column:
        floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
        return (nan_to_null(_col(name)) if floating else _col(name)).cast("string")

    entries = [F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in names]
    return _rows(df, entries).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows (column, distinct); null is not counted."""
    return distinct_values(df, names).groupBy("column").agg(F.count("value").alias("distinct"))


def zero_counts(df: DataFrame, by_column: bool = False) -> DataFrame:
    """Zeros over all columns, or rows (column, zeros)."""
    tests = {c: _zero(df, c) for c in df.columns}
    wide = df.agg(
        *[
            (F.lit(0).cast("long") if t is None else F.count_if(t)).alias(f"n{i}")
            for i, t in enumerate(tests.values())
        ]
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("zeros"))
        for i, c in enumerate(tests)
    ]
    rows = _rows(wide, entries)
    return rows if by_column else rows.agg(F.sum("zeros").alias("zeros"))


def duplicated_rows(df: DataFrame) -> DataFrame:
    """Every copy of a row that occurs more than once.

    Copies are counted with partial sums first, so a row repeated very often is never
    gathered in one task; AQE splits its partition in the semi join.
    """
    repeated = df.groupBy(*[_col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return join_null_safe(df, repeated.drop("__n"), df.columns, "left_semi")


def value_class(c: Column) -> Column:
    """Class of a text value: int, decimal, date, bool or text; null stays null."""
    value = F.trim(c)
    return (
        F.when(value.isNull(), None)
        .when(value.rlike(r"^[-+]?\d{1,18}$"), "int")
        .when(value.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), "decimal")
        .when(
            value.rlike(r"^\d{4}-\d{2}-\d{2}") & value.try_cast("timestamp").isNotNull(), "date"
        )
        .when(F.lower(value).isin("true", "false"), "bool")
        .otherwise("text")
    )


def value_classes(df: DataFrame, names: Sequence[str], order: str) -> DataFrame:
    """Rows (column, base_class, base_at, class, n); base is the first non-null value by order."""
    entries = [
        F.struct(F.lit(c).alias("column"), value_class(_col(c)).alias("class")) for c in names
    ]
    counted = (
        _rows(df, entries, [order])
        .filter(F.col("class").isNotNull())
        .groupBy("column", "class")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_at"))
    )
    base = counted.groupBy("column").agg(
        F.min_by("class", "first_at").alias("base_class"), F.min("first_at").alias("base_at")
    )
    return counted.join(base, "column").select("column", "base_class", "base_at", "class", "n")


def inconsistent_rows(df: DataFrame, names: Sequence[str], order: str) -> DataFrame:
    """Rows (order, column, value, class, base_class) whose class is not the column's first one."""
    entries = [
        F.struct(
            F.lit(c).alias("column"), _col(c).alias("value"), value_class(_col(c)).alias("class")
        )
        for c in names
    ]
    # One row per column name.
    base = F.broadcast(value_classes(df, names, order).select("column", "base_class").distinct())
    rows = _rows(df, entries, [order]).filter(F.col("class").isNotNull())
    return rows.join(base, "column").filter(F.col("class") != F.col("base_class"))


def describe(
    df: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows (*by, column, n, mean, std, min, q25, q50, q75, max)."""
    names = list(names)
    values = [nan_to_null(_col(c).cast("double")) for c in names]
    aggregates = []
    for i, x in enumerate(values):
        aggregates += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{k}{i}").alias(k) for k in ("n", "mean", "std", "min", "max")],
        )
        for i, c in enumerate(names)
    ]
    probs = (0.25, 0.5, 0.75)
    first = first_scan(df, names, probs, by, aggregates)
    basics = _rows(first, entries, by)
    cuts = exact_quantiles(df, names, probs, by, first)
    keys = [*by, "column"]
    q = F.col("q")
    return join_null_safe(basics, cuts, keys, "left").select(
        *keys, "n", "mean", "std", "min",
        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "max",
    )


def correlations(df: DataFrame, names: Sequence[str] | None = None, listwise: bool = False):
    """Rows (a, b, corr) for every pair, both ways and the diagonal.

    Pairwise by default: each pair skips its own nulls. ``listwise`` first drops every row
    with a null in any column.
    """
    names = list(names or numeric_columns(df))
    rows = df.select(*[nan_to_null(_col(c).cast("double")).alias(c) for c in names])
    if listwise:
        rows = rows.dropna("any")
    pairs = [(c, c) for c in names] + list(combinations(names, 2))
    wide = rows.agg(*[F.corr(_col(a), _col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            entries.append(
                F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"c{i}").alias("corr"))
            )
    return _rows(wide, entries)


def correlation_matrix(df: DataFrame, names: Sequence[str] | None = None, listwise: bool = False):
    """The same as a square: one row per column name."""
    names = list(names or numeric_columns(df))
    return (
        correlations(df, names, listwise)
        .groupBy("a")
        .pivot("b", names)
        .agg(F.first("corr"))
        .withColumnRenamed("a", "column")
    )


def correlation_with(df: DataFrame, target: str, names: Sequence[str]) -> DataFrame:
    """Rows (column, corr) against one target over complete rows, ascending."""
    rows = df.select(*[nan_to_null(_col(c).cast("double")).alias(c) for c in (*names, target)])
    wide = rows.dropna("any").agg(
        *[F.corr(_col(c), _col(target)).alias(f"c{i}") for i, c in enumerate(names)]
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("corr"))
        for i, c in enumerate(names)
    ]
    return _rows(wide, entries).orderBy("corr", "column")


def outlier_bounds(
    df: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows (*by, column, q1, q3, low, high) of the interquartile rule."""
    cuts = exact_quantiles(df, names, (0.25, 0.75), by)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    reach = (q3 - q1) * IQR_FACTOR
    return cuts.select(
        *by, "column", q1.alias("q1"), q3.alias("q3"),
        (q1 - reach).alias("low"), (q3 + reach).alias("high"),
    )


def _cells(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    entries = [
        F.struct(F.lit(c).alias("column"), nan_to_null(_col(c).cast("double")).alias("value"))
        for c in names
    ]
    return _rows(df, entries, by).filter(F.col("value").isNotNull())


def _bounded_cells(df, names, by):
    cells = _cells(df, names, by)
    bounds = outlier_bounds(df, names, by)
    return join_null_safe(cells, materialise(bounds), [*by, "column"])


def outlier_rows(
    df: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows (*by, column, value) strictly outside the bounds.

    Without groups the bounds are one row per column: they become literals, and the filter
    reaches the scan.
    """
    if by:
        rows = _bounded_cells(df, names, by)
        out = rows.filter((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))
        return out.select(*by, "column", "value")
    found = _literal_bounds(df, names)
    outside = {c: (_col(c) < b.low) | (_col(c) > b.high) for c, b in found.items()}
    anywhere = F.lit(False)
    for test in outside.values():
        anywhere = anywhere | test
    entries = [
        F.struct(F.lit(c).alias("column"), F.when(test, _col(c).cast("double")).alias("value"))
        for c, test in outside.items()
    ]
    return _rows(df.filter(anywhere), entries).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def _literal_bounds(df: DataFrame, names: Sequence[str]) -> dict:
    """Ungrouped bounds as literals: one row per column, null without any value."""
    kinds = ("q1", "q3", "low", "high")
    rows = {r["column"]: r for r in outlier_bounds(df, names).collect()}
    bounds = namedtuple("Bounds", kinds)
    return {c: bounds(*[F.lit(rows[c][k]).cast("double") for k in kinds]) for c in names}


def _bounded_figures(df, names, by, figures):
    """Aggregates of values and their bounds: ``figures(value, low, high)`` -> name -> column.

    Without groups one conditional aggregate over the frame does; columns without a value have
    null bounds. With groups each value meets its group's bounds.
    """
    if by:
        aggregates = figures(F.col("value"), F.col("low"), F.col("high"))
        fixed = [F.max(k).alias(k) for k in ("q1", "q3", "low", "high")]
        rows = _bounded_cells(df, names, by).groupBy(*by, "column")
        return rows.agg(*fixed, *[c.alias(k) for k, c in aggregates.items()])
    wide, entries = [], []
    for i, (name, bound) in enumerate(_literal_bounds(df, names).items()):
        value = nan_to_null(_col(name).cast("double"))
        made = figures(value, bound.low, bound.high)
        wide += [c.alias(f"{k}{i}") for k, c in made.items()]
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                *[getattr(bound, k).alias(k) for k in ("q1", "q3", "low", "high")],
                *[F.col(f"{k}{i}").alias(k) for k in made],
            )
        )
    return _rows(df.agg(*wide), entries)


def outlier_summary(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, column, low, high, outliers)."""
    figures = lambda x, low, high: {"outliers": F.count_if((x < low) | (x > high))}
    return _bounded_figures(df, names, by, figures).select(*by, "column", "low", "high", "outliers")


def box_figures(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, column, q1, q3, whisker_low, whisker_high, fliers)."""

    def figures(x: Column, low: Column, high: Column) -> dict[str, Column]:
        inside = x.between(low, high)
        return {
            "whisker_low": F.min(F.when(inside, x)),
            "whisker_high": F.max(F.when(inside, x)),
            "fliers": F.count_if(~inside),
        }

    made = _bounded_figures(df, names, by, figures)
    return made.select(*by, "column", "q1", "q3", "whisker_low", "whisker_high", "fliers")


def histogram(df: DataFrame, name: str, bins: int = 30) -> DataFrame:
    """Rows (bin, low, high, n): equal widths from min to max, last bin closed, empty bins kept."""
    values = df.select(nan_to_null(_col(name).cast("double")).alias("x")).dropna()
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = ends.first()
    if lo is None:
        return ends.limit(0).selectExpr("0 bin", "lo low", "hi high", "0L n")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    place = F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins) + 1, F.lit(bins)).cast("int")
    counted = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counted, "bin", "left").select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * width).alias("low"),
        (F.lit(lo) + F.col("bin") * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
