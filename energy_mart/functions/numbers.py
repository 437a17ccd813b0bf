"""Numeric expressions: lenient casts, sentinels, zeros and nulls, scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from energy_mart.functions.text import blank_to_null, boolean_text, strip, strip_sql

SENTINEL = -999.0


def lenient_double_sql(name: str) -> str:
    return f"nullif(TRY_CAST({strip_sql(name)} AS DOUBLE), double('NaN'))"


def lenient_int_sql(name: str) -> str:
    value = lenient_double_sql(name)
    return f"TRY_CAST(CASE WHEN {value} = floor({value}) THEN {value} END AS INT)"


def lenient_double(c: Column) -> Column:
    """Number from text or number; bad text and NaN give null."""
    return nan_to_null(strip(c.cast("string")).try_cast("double"))


def lenient_int(c: Column) -> Column:
    """Whole number; text such as ``2020.0`` counts, anything else gives null."""
    return whole(lenient_double(c)).try_cast("int")


def whole(c: Column) -> Column:
    """The number if it has no fraction, else null."""
    return F.when(c == F.floor(c), c)


def nan_to_null(c: Column) -> Column:
    """NaN equals NaN in Spark, so one comparison does; the value is evaluated once."""
    return F.nullif(c, F.lit(float("nan")))


def sentinel_to_null(c: Column, sentinel: float = SENTINEL) -> Column:
    return F.nullif(c, F.lit(sentinel))


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def null_to_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def percent_change(new: Column, old: Column) -> Column:
    """(new - old) / old in percent; null when the base is zero or missing."""
    return F.try_divide(new - old, old) * 100


def scaled(c: Column, unit: float, decimals: int) -> Column:
    """Value in units of ``unit``, rounded half up."""
    return F.round(c / F.lit(float(unit)), decimals)


def converted(c: Column, kind: str) -> Column:
    """``int`` and ``datetime`` forgive bad text, ``float`` is strict, other names do nothing."""
    kind = kind.lower()
    if kind == "int":
        return lenient_double(c)
    if kind == "float":
        return c.cast("double")
    if kind == "str":
        return c.cast("string")
    if kind == "bool":
        return boolean_text(blank_to_null(c.cast("string")))
    if kind == "datetime":
        return strip(c.cast("string")).try_cast("timestamp")
    return c
