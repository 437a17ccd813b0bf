"""Cleaning recipes per domain, and the wide price + climate table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.functions import text
from energy_mart.functions.numbers import lenient_double, lenient_int
from energy_mart.functions.text import clean_key
from energy_mart.operators.aggregate import reconcile_totals
from energy_mart.operators.filters import TOTAL_ROW, without_total
from energy_mart.operators.profile import keep_complete
from energy_mart.operators.project import (
    drop_columns,
    keep_existing,
    numeric_columns,
    quoted,
    reproject,
    swap_zero_null,
    to_model,
    trim_names,
)

KEYS = ["Empresa", "Año", "Mes"]
WIDE_SORT = ["Empresa", "Tarifa", "Año", "Mes"]


def clean_prices(raw: DataFrame) -> DataFrame:
    """Trimmed keys, month names to numbers, lenient numbers, total row and keyless rows out."""
    df = trim_names(raw)
    changes = {"Mes": text.month_number(F.col("Mes").cast("string")), "Año": lenient_int(F.col("Año"))}
    for name in ("Empresa", "Tarifa"):
        if name in df.columns:
            changes[name] = clean_key(text.blank_to_null(F.col(name).cast("string")))
    for name in ("Ventas", "Ingreso con CVG", "Precio Medio con CVG"):
        if name in df.columns:
            changes[name] = lenient_double(F.col(quoted(name)))
    return without_total(df.withColumns(changes), "Empresa").dropna(subset=["Año", "Mes", "Empresa"])


def price_reconciliation(raw: DataFrame) -> DataFrame:
    """Published national total against the sum of companies, on the raw rows.

    Runs before cleaning, which removes the total row; months keep their raw text.
    """
    df = trim_names(raw)
    rows = df.select(
        lenient_int(F.col("Año")).alias("ano"),
        F.col("Mes").alias("mes"),
        clean_key(text.blank_to_null(F.col("Empresa").cast("string"))).alias("empresa"),
        lenient_double(F.col("`Ingreso con CVG`")).alias("ingreso"),
    ).dropna(subset=["empresa"])
    return reconcile_totals(rows, F.col("empresa") == TOTAL_ROW, "ingreso", ["ano", "mes"])


def reconciliation_text(rows: DataFrame, first: int = 12) -> DataFrame:
    """The printed form: thousands separators, two decimals, percent sign; first n months."""
    return rows.orderBy("ano", "mes").limit(first).select(
        "ano",
        "mes",
        text.thousands(F.col("parts")).alias("parts"),
        text.thousands(F.col("published")).alias("published"),
        text.thousands(F.col("difference")).alias("difference"),
        text.thousands(F.col("difference_millions"), 2).alias("difference_millions"),
        text.percent_text(F.col("difference_pct")).alias("difference_pct"),
    )


def wide_table(prices: DataFrame, climate: DataFrame) -> DataFrame:
    """Every price row with its company's climate of the month, if any."""
    return prices.join(climate, KEYS, "left")


def report_table(wide: DataFrame) -> DataFrame:
    """The wide table with typed staging names, as the reports take it."""
    measures = [f for f in schemas.CLIMATE if f.type == "double"]
    return to_model(wide, (*schemas.PRICES, *measures))


def prepare_prices(cleaned: DataFrame) -> DataFrame:
    return keep_existing(cleaned, schemas.layout(schemas.PRICES))


def prepare_climate(cleaned: DataFrame) -> DataFrame:
    return keep_existing(cleaned, schemas.layout(schemas.CLIMATE))


def prepare_plants(raw: DataFrame) -> DataFrame:
    """Metres to degrees, then the layout."""
    return keep_existing(
        reproject(raw, lat="coordenadaY", lon="coordenadaX"), schemas.layout(schemas.PLANTS)
    )


def prepare_zones(raw: DataFrame) -> DataFrame:
    """Geometry class from the WKT prefix, then the layout."""
    classed = raw.withColumn("tipo_geometria", text.geometry_class(F.col("coordenadas")))
    return keep_existing(classed, schemas.layout(schemas.ZONES))


def prepare_distribution(raw: DataFrame) -> DataFrame:
    """Layout columns that hold no null."""
    return keep_complete(raw, schemas.DISTRIBUTION_LAYOUT)


def prepare_fuels(raw: DataFrame) -> DataFrame:
    """Two columns out, layout, numeric nulls to zero."""
    kept = keep_existing(drop_columns(raw, schemas.FUEL_DROPPED), schemas.layout(schemas.FUELS))
    return swap_zero_null(kept, numeric_columns(kept), to_zero=True)


def typed_fuels(raw: DataFrame) -> DataFrame:
    """Text fuel columns as the numbers a file reader would infer, before ``prepare_fuels``."""
    numeric = [f for f in schemas.FUELS if f.type in ("double", "int") and f.source in raw.columns]
    return raw.withColumns(
        {
            f.source: (lenient_int if f.type == "int" else lenient_double)(F.col(quoted(f.source)))
            for f in numeric
        }
    )
