"""Calendar expressions: month dates, parts, periods and seasons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from energy_mart.functions.text import month_name

# Period labels in display order; other years take the last one.
PERIODS = {
    "Pandemia (2020-2021)": (2020, 2021),
    "Recuperacion (2022-2023)": (2022, 2023),
}
LAST_PERIOD = "Expansion (2024-2025)"

# Seasons; other months take the rainy one.
SUMMER = "Verano (Dic-Abr)"
RAINY = "Lluvioso (May-Nov)"
SUMMER_MONTHS = (12, 1, 2, 3, 4)


def month_date(year: Column, month: Column) -> Column:
    """First day of the month; null outside 1..12."""
    return F.when(month.between(1, 12) & year.isNotNull(), F.make_date(year, month, F.lit(1)))


def yyyymm_date(c: Column) -> Column:
    """Month date from ``yyyyMM`` text; the yearly key (month 13) gives null."""
    return F.try_to_date(F.when(~is_yearly_key(c), F.concat(c, F.lit("01"))), "yyyyMMdd")


def is_yearly_key(c: Column) -> Column:
    return F.substring(c, -2, 2) == "13"


def date_parts(c: Column) -> dict[str, Column]:
    """Calendar attributes of a date, by their dimension names."""
    return {
        "anio": F.year(c),
        "mes": F.month(c),
        "dia": F.dayofmonth(c),
        "trimestre": F.quarter(c),
        "nombre_mes": month_name(F.month(c)),
        "anio_mes": F.year(c) * 100 + F.month(c),
    }


def period_label(
    year: Column,
    periods: Mapping[str, Sequence[int]] = PERIODS,
    otherwise: str = LAST_PERIOD,
) -> Column:
    out = F.lit(otherwise)
    for label, years in periods.items():
        out = F.when(year.isin(*years), label).otherwise(out)
    return out


def period_order(
    label: Column,
    periods: Mapping[str, Sequence[int]] = PERIODS,
    otherwise: str = LAST_PERIOD,
) -> Column:
    """Display position of a period label."""
    out = F.lit(None).cast("int")
    for place, name in enumerate([*periods, otherwise]):
        out = F.when(label == name, place).otherwise(out)
    return out


def season_label(month: Column) -> Column:
    return F.when(month.isin(*SUMMER_MONTHS), SUMMER).otherwise(RAINY)
