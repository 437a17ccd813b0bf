"""Accept/reject split and the constraint checks Spark does not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.functions.numbers import whole
from energy_mart.functions.text import blank_to_null, is_bad_boolean
from energy_mart.operators.joins import join_null_safe
from energy_mart.operators.profile import null_counts
from energy_mart.operators.project import quoted
from energy_mart.schemas import Field

REASONS = "reject_reasons"


def length_rules(widths: Mapping[str, int]) -> dict[str, Column]:
    return {
        f"{name} longer than {width}": F.length(quoted(name)) > width
        for name, width in widths.items()
    }


def source_rules(df: DataFrame, fields: Sequence[Field]) -> dict[str, Column]:
    """Rules for source rows about to enter a staging model: type, width, boolean words."""
    rules = {}
    for f in fields:
        if f.source not in df.columns:
            continue
        c = F.col(quoted(f.source))
        given = blank_to_null(c.cast("string")).isNotNull()
        if f.type == "boolean":
            rules[f"{f.name} is not a boolean"] = given & is_bad_boolean(c)
        elif f.type == "int":
            rules[f"{f.name} is not int"] = given & whole(c.try_cast("double")).try_cast("int").isNull()
        elif f.type == "date":
            rules[f"{f.name} is not date"] = given & c.try_cast("timestamp").isNull()
        elif f.type != "string":
            rules[f"{f.name} is not {f.type}"] = given & c.try_cast(f.type).isNull()
        elif f.width:
            rules[f"{f.name} longer than {f.width}"] = F.length(c) > f.width
    return rules


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the list of broken rules to each row."""
    reasons = [F.when(broken, reason) for reason, broken in rules.items()]
    listed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return df.withColumn(REASONS, listed)


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reasons)."""
    marked = with_reasons(df, rules)
    return (
        marked.filter(F.size(REASONS) == 0).drop(REASONS),
        marked.filter(F.size(REASONS) > 0),
    )


def split_repeated(
    df: DataFrame, keys: Sequence[str], order: str
) -> tuple[DataFrame, DataFrame]:
    """(first row of each key by ``order``, the later ones with a reason); ``order`` is unique.

    A minimum per key combines before the shuffle, so one very frequent key is no hot task.
    """
    first = df.groupBy(*keys).agg(F.min(order).alias("__first"))
    marked = join_null_safe(df, first, keys)
    kept = marked.filter(F.col(order) == F.col("__first")).drop("__first")
    later = marked.filter(F.col(order) != F.col("__first")).drop("__first")
    reason = F.array(F.lit(f"repeated {', '.join(keys)}"))
    return kept, later.withColumn(REASONS, reason)


def load_summary(df: DataFrame, rules: Mapping[str, Column], table: str) -> DataFrame:
    """One row: table, total, accepted, rejected."""
    good = F.size(REASONS) == 0
    return with_reasons(df, rules).agg(
        F.lit(table).alias("table"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(good).alias("accepted"),
        F.count_if(~good).alias("rejected"),
    )


def repeated_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with the count."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphan_rows(df: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Rows whose non-null key is not in the dimension."""
    present = dimension.select(F.col(dimension_key).alias("__key"))
    rows = df.filter(F.col(key).isNotNull())
    return rows.join(present, rows[key] == present["__key"], "left_anti")


def missing_values(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows (column, nulls) for columns that must not be null."""
    return null_counts(df.select(*[quoted(c) for c in required]), "all").select("column", "nulls")


def lookup_losses(
    df: DataFrame, dimension: DataFrame, keys: Mapping[str, str], count_by: Sequence[str] = ()
) -> DataFrame:
    """Rows an inner lookup would drop silently, counted (optionally by some columns)."""
    names = list(keys)
    present = dimension.select(*[F.col(d).alias(n) for n, d in keys.items()]).distinct()
    lost = df.join(present, names, "left_anti")
    return lost.groupBy(*count_by).agg(F.count(F.lit(1)).alias("lost"))


def check_frame(df: object) -> DataFrame:
    if not isinstance(df, DataFrame):
        raise ValueError("an active DataFrame is needed")
    return df
