"""Column selection, renaming and tolerant projection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energy_mart.functions import text
from energy_mart.functions.dates import date_parts
from energy_mart.functions.geo import with_lon_lat
from energy_mart.functions.numbers import (
    converted,
    lenient_double_sql,
    lenient_int_sql,
    null_to_zero,
    sentinel_to_null,
    zero_to_null,
)
from energy_mart.schemas import Field


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Wanted columns that exist, in the wanted order."""
    return df.select(*[quoted(c) for c in wanted if c in df.columns])


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; an unknown name is an error."""
    return require_columns(df, names).drop(*names)


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def duplicate_names(df: DataFrame) -> dict[str, int]:
    """Column names that occur more than once, with their count."""
    return {name: n for name, n in Counter(df.columns).items() if n > 1}


def numeric_columns(df: DataFrame, reverse: bool = False) -> list[str]:
    """Names of numeric columns, or of all others; booleans are not numeric."""
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) is not reverse
    ]


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def convert(df: DataFrame, names: Sequence[str], kind: str) -> DataFrame:
    return df.withColumns({c: converted(F.col(quoted(c)), kind) for c in names})


def swap_zero_null(
    df: DataFrame, names: Sequence[str] | str | None = None, to_zero: bool = False
) -> DataFrame:
    """Zeros to nulls, or nulls to zeros, on the chosen numeric columns (all by default)."""
    if names is None:
        names = numeric_columns(df)
    elif isinstance(names, str):
        names = [names]
    swap = null_to_zero if to_zero else zero_to_null
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: swap(F.col(quoted(c))).cast(types[c]) for c in names})


def clear_sentinel(df: DataFrame, names: Sequence[str], sentinel: float = -999.0) -> DataFrame:
    return df.withColumns({c: sentinel_to_null(F.col(quoted(c)), sentinel) for c in names})


def add_date_parts(df: DataFrame, name: str) -> DataFrame:
    """Add ``<name>_year`` and ``<name>_month``; nothing when the column is missing."""
    if name not in df.columns:
        return df
    out = convert(df, [name], "datetime")
    parts = date_parts(F.col(quoted(name)))
    return out.withColumns({f"{name}_year": parts["anio"], f"{name}_month": parts["mes"]})


def split_token(
    df: DataFrame,
    name: str,
    index: int = 0,
    new_name: str | None = None,
    rest_name: str | None = None,
    drop: bool = True,
) -> DataFrame:
    """One blank-separated token to a new column, optionally the rest to another."""
    require_columns(df, [name])
    source = F.col(quoted(name))
    added = {new_name or f"New_col_{name}": text.token(source, index)}
    if rest_name is not None:
        added[rest_name] = text.without_token(source, index)
    out = df.withColumns(added)
    return out.drop(name) if drop and name not in added else out


def reproject(
    df: DataFrame,
    lat: str | None = None,
    lon: str | None = None,
    default_lat: str = "coordenadaY",
    default_lon: str = "coordenadaX",
) -> DataFrame:
    """Named coordinate columns from projected metres to degrees.

    One named column borrows the default other one and is the only one rewritten.
    """
    if lat is None and lon is None:
        return df
    require_columns(df, [lat or default_lat, lon or default_lon])
    out = with_lon_lat(
        df, quoted(lon or default_lon), quoted(lat or default_lat), lon or "__lon", lat or "__lat"
    )
    return out.drop("__lon", "__lat")


def to_model(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Project source columns onto a staging model; a missing source column is null."""
    return df.selectExpr(*[f"{_cell(df, f)} AS {quoted(f.name)}" for f in fields])


def to_source_names(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The other direction: staging names back to the published ones."""
    return df.withColumnsRenamed({f.name: f.source for f in fields if f.name in df.columns})


def _cell(df: DataFrame, field: Field) -> str:
    """SQL text of one lenient cast: a model has many columns, and text plans them in one call."""
    if field.source not in df.columns:
        return f"CAST(NULL AS {field.type})"
    source = quoted(field.source)
    if field.type == "boolean":
        return text.boolean_sql(source)
    if field.type == "int":
        return lenient_int_sql(source)
    if field.type == "double":
        return lenient_double_sql(source)
    if field.type == "date":
        return f"CAST(TRY_CAST({source} AS TIMESTAMP) AS DATE)"
    return f"TRY_CAST({source} AS {field.type})"


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column missing in one frame is null there."""
    if not frames:
        raise ValueError("no frames to stack")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
