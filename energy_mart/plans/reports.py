"""Report queries over the wide price + climate table (staging column names)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energy_mart.functions import text
from energy_mart.functions.dates import (
    LAST_PERIOD,
    PERIODS,
    RAINY,
    SUMMER,
    month_date,
    period_label,
    period_order,
    season_label,
)
from energy_mart.functions.numbers import percent_change
from energy_mart.operators import profile
from energy_mart.operators.aggregate import (
    compare_slices,
    linear_trend,
    matrix,
    mean_of_means,
    month_matrix,
    share_of_total,
    top_and_others,
    top_rows,
    total,
    trend_points,
)
from energy_mart.operators.filters import chosen
from energy_mart.operators.project import clear_sentinel
from energy_mart.schemas import CLIMATE_MEASURES
from energy_mart.plans.views import NO_BLOCK

# Column choices of the exploration reports.
DESCRIBED = (
    "ventas", "ingreso_con_cvg", "precio_medio_con_cvg", "t2m", "ws10m", "rh2m", "prectotcorr",
)
OUTLIER_COLUMNS = ("ventas", "ingreso_con_cvg", "precio_medio_con_cvg", "t2m", "prectotcorr")
BOX_COLUMNS = ("ventas", "precio_medio_con_cvg", "prectotcorr")
HISTOGRAM_COLUMNS = ("t2m", "ws10m", "rh2m", "prectotcorr")
CORRELATED = (
    "ventas", "ingreso_con_cvg", "precio_medio_con_cvg", "t2m", "ws10m", "rh2m", "cloud_amt",
    "prectotcorr", "t2m_max",
)
CLIMATE_PAGE = (
    "t2m", "ws10m", "cloud_amt", "rh2m", "t2m_max", "t2m_min", "prectotcorr",
    "allsky_sfc_sw_dwn", "ps",
)
# Tariffs and companies of the hypothesis pages.
RESIDENTIAL, COMMERCE = "RESIDENCIAL", "COMERCIOS Y SERVICIOS"
WARM_COMPANY, VALLEY_COMPANY = "COOPEGUANACASTE", "CNFL"
TEMPERATURE_COMPANIES = ("COOPEGUANACASTE", "CNFL", "COOPEALFARORUIZ", "ESPH")

Periods = Mapping[str, Sequence[int]]


def base(
    wide: DataFrame, periods: Periods = PERIODS, last_period: str = LAST_PERIOD
) -> DataFrame:
    """Sentinels out, period and season labels in."""
    climate = [c for c in CLIMATE_MEASURES if c in wide.columns]
    return clear_sentinel(wide, climate).withColumns(
        {
            "periodo": period_label(F.col("ano"), periods, last_period),
            "estacion": season_label(F.col("mes")),
        }
    )


def filtered(df: DataFrame, years: Sequence[int] | None = None, companies=None) -> DataFrame:
    """The page-wide filter on year and company."""
    return chosen(df, ano=years, empresa=companies)


def choices(df: DataFrame, name: str) -> DataFrame:
    """Sorted distinct values for a picker."""
    return df.select(name).dropna().distinct().orderBy(name)


# ---- overview -----------------------------------------------------------------------

def key_figures(df: DataFrame) -> DataFrame:
    return df.agg(
        total("ventas").alias("ventas_total"),
        total("ingreso_con_cvg").alias("ingreso_total"),
        F.avg("precio_medio_con_cvg").alias("precio_promedio"),
        F.avg("t2m").alias("temperatura_promedio"),
    )


def yearly_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("ano").agg(
        total("ventas").alias("ventas"), total("ingreso_con_cvg").alias("ingreso")
    ).orderBy("ano")


def sales_by(df: DataFrame, key: str, descending: bool = False) -> DataFrame:
    sums = df.filter(F.col(key).isNotNull()).groupBy(key).agg(total("ventas").alias("ventas"))
    order = F.col("ventas").desc() if descending else F.col("ventas").asc()
    return sums.orderBy(order, key)


def market_share(df: DataFrame, n: int = 5) -> DataFrame:
    """Top companies, the others as one row, percent of all sales."""
    return share_of_total(top_and_others(df, "empresa", "ventas", n), "ventas")


def company_month_matrix(df: DataFrame, value: str = "ventas") -> DataFrame:
    return month_matrix(df.filter(F.col("empresa").isNotNull()), "empresa", value)


# ---- pandemic hypothesis ------------------------------------------------------------

def labelled(df: DataFrame, labels: Mapping[str, str] = text.TARIFF_LABELS) -> DataFrame:
    return df.withColumn("tarifa_label", text.tariff_label(F.col("tarifa"), labels)).filter(
        F.col("tarifa_label").isNotNull()
    )


def period_means(
    df: DataFrame,
    labels: Mapping[str, str] = text.TARIFF_LABELS,
    periods: Periods = PERIODS,
    last_period: str = LAST_PERIOD,
) -> DataFrame:
    """Mean sales by period and tariff label, in display order of the periods."""
    means = labelled(df, labels).groupBy("periodo", "tarifa_label").agg(F.avg("ventas").alias("ventas"))
    place = period_order(F.col("periodo"), periods, last_period)
    return means.withColumn("periodo_ord", place).orderBy("periodo_ord", "tarifa_label")


def period_change(
    df: DataFrame,
    labels: Mapping[str, str] = text.TARIFF_LABELS,
    periods: Periods = PERIODS,
    last_period: str = LAST_PERIOD,
) -> DataFrame:
    """Period columns by tariff label, and the change from the first to the second period."""
    names = [*periods, last_period]
    wide = matrix(labelled(df, labels), "tarifa_label", "periodo", names, F.avg("ventas"))
    change = percent_change(F.col(f"`{names[1]}`"), F.col(f"`{names[0]}`"))
    return wide.withColumn("var_pct", F.round(change, 1)).orderBy("var_pct", "tarifa_label")


def tariff_comparison(
    df: DataFrame, tariffs: Sequence[str], first_years: Sequence[int], second_years: Sequence[int]
) -> DataFrame:
    """Mean sales of each tariff in two groups of years, with the change."""
    return compare_slices(
        df.filter(F.col("tarifa").isin(*tariffs)),
        "ventas",
        F.col("ano").isin(*first_years),
        F.col("ano").isin(*second_years),
        ["tarifa"],
    )


def yearly_tariff_means(
    df: DataFrame, tariffs: Sequence[str] | None = None, value: str = "ventas"
) -> DataFrame:
    rows = chosen(df, tarifa=tariffs)
    return rows.groupBy("ano", "tarifa").agg(F.avg(value).alias(value)).orderBy("tarifa", "ano")


# ---- summer hypothesis --------------------------------------------------------------

def season_months(df: DataFrame, tariff: str | None = None) -> DataFrame:
    rows = df if tariff is None else df.filter(F.col("tarifa") == tariff)
    return rows.groupBy("estacion", "mes").agg(
        F.avg("ventas").alias("ventas"), F.avg("t2m").alias("t2m")
    ).orderBy("mes")


def month_means(df: DataFrame) -> DataFrame:
    return df.groupBy("mes").agg(
        F.avg("ventas").alias("ventas"), F.avg("t2m").alias("t2m")
    ).orderBy("mes")


def season_temperature(df: DataFrame) -> DataFrame:
    """Company by season, rounded to one decimal, with the difference."""
    rows = df.filter(F.col("empresa").isNotNull())
    wide = matrix(rows, "empresa", "estacion", [SUMMER, RAINY], F.round(F.avg("t2m"), 1))
    return (
        wide.withColumnsRenamed({SUMMER: "verano", RAINY: "lluvioso"})
        .withColumn("diferencia", F.col("verano") - F.col("lluvioso"))
        .orderBy("verano", "empresa")
    )


def season_comparison(df: DataFrame, value: str = "ventas", by: Sequence[str] = ()) -> DataFrame:
    """Rainy season first, summer second, with the change."""
    return compare_slices(
        df, value, F.col("estacion") == RAINY, F.col("estacion") == SUMMER, by
    )


def temperature_trend(df: DataFrame, tariff: str = RESIDENTIAL) -> DataFrame:
    """Line of sales in millions on temperature for one tariff."""
    rows = df.filter(F.col("tarifa") == tariff).dropna(
        subset=["t2m", "ventas", "empresa", "estacion"]
    )
    return linear_trend(rows.withColumn("ventas_m", F.col("ventas") / 1e6), "t2m", "ventas_m")


# ---- regional comparison ------------------------------------------------------------

def regional_figures(
    df: DataFrame, warm: str = WARM_COMPANY, valley: str = VALLEY_COMPANY
) -> DataFrame:
    """Temperatures of two companies, seasonal sales of the first and their change: one pass."""
    at_warm = F.col("empresa") == warm
    summer, rainy = F.col("estacion") == SUMMER, F.col("estacion") == RAINY
    out = df.filter(F.col("empresa").isin(warm, valley)).agg(
        F.avg(F.when(at_warm, F.col("t2m"))).alias("t2m_first"),
        F.avg(F.when(~at_warm, F.col("t2m"))).alias("t2m_second"),
        F.avg(F.when(at_warm & summer, F.col("ventas"))).alias("ventas_verano"),
        F.avg(F.when(at_warm & rainy, F.col("ventas"))).alias("ventas_lluvioso"),
    )
    change = percent_change(F.col("ventas_verano"), F.col("ventas_lluvioso"))
    return out.withColumn("dif_pct", change)


def company_month_means(df: DataFrame, companies: Sequence[str], value: str = "ventas") -> DataFrame:
    return (
        chosen(df, empresa=companies)
        .groupBy("empresa", "mes")
        .agg(F.avg(value).alias(value))
        .orderBy("empresa", "mes")
    )


def tariff_month_matrix(df: DataFrame, company: str = WARM_COMPANY) -> DataFrame:
    return month_matrix(df.filter(F.col("empresa") == company), "tarifa", "ventas")


# ---- sales evolution ----------------------------------------------------------------

def monthly_series(df: DataFrame, companies: Sequence[str] | None = None, value: str = "ventas"):
    """Monthly totals by company, with the first day of the month."""
    sums = (
        chosen(df, empresa=companies)
        .filter(F.col("empresa").isNotNull())
        .groupBy("ano", "mes", "empresa")
        .agg(total(value).alias(value))
    )
    return sums.withColumn("fecha", month_date(F.col("ano"), F.col("mes")))


def monthly_temperature(df: DataFrame) -> DataFrame:
    means = df.groupBy("ano", "mes", "empresa").agg(F.avg("t2m").alias("t2m"))
    return means.withColumn("fecha", month_date(F.col("ano"), F.col("mes")))


# ---- climate against sales ----------------------------------------------------------

def climate_correlations(df: DataFrame, names: Sequence[str] = CLIMATE_PAGE) -> DataFrame:
    return profile.correlation_with(df, "ventas", names)


def strongest(correlations: DataFrame, n: int = 3) -> DataFrame:
    """Last n and first n of the sorted correlations."""
    high = correlations.orderBy(F.col("corr").desc(), "column").limit(n)
    low = correlations.orderBy("corr", "column").limit(n)
    return high.withColumn("side", F.lit("alta")).unionByName(low.withColumn("side", F.lit("baja")))


def climate_trend_points(df: DataFrame, name: str, names: Sequence[str] = CLIMATE_PAGE) -> DataFrame:
    """100 points of the line of sales in millions on one variable, over complete rows."""
    rows = df.dropna(subset=[*names, "ventas", "empresa"])
    return trend_points(rows.withColumn("ventas_m", F.col("ventas") / 1e6), name, "ventas_m")


# ---- exploration --------------------------------------------------------------------

def seasonality(df: DataFrame) -> DataFrame:
    """Mean by month beside the mean of those means."""
    months = df.filter(F.col("mes").isNotNull()).groupBy("mes").agg(F.avg("ventas").alias("ventas"))
    overall = mean_of_means(df.filter(F.col("mes").isNotNull()), "mes", "ventas")
    return months.withColumn("promedio_global", overall.scalar()).orderBy("mes")


def top_tariff_prices(df: DataFrame, n: int = 5) -> DataFrame:
    """Yearly mean price of the n tariffs with the largest sales."""
    sums = df.filter(F.col("tarifa").isNotNull()).groupBy("tarifa").agg(total("ventas").alias("v"))
    top = top_rows(sums, "v", "tarifa", n).select("tarifa")
    means = yearly_tariff_means(df, None, "precio_medio_con_cvg")
    return means.join(F.broadcast(top), "tarifa", "left_semi")  # n rows at most


def company_summary(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("empresa").isNotNull())
        .groupBy("empresa")
        .agg(
            F.count("ventas").alias("registros"),
            F.round(total("ventas") / 1e6, 1).alias("ventas_total_m"),
            F.round(F.avg("ventas") / 1e6, 2).alias("ventas_prom_m"),
            F.round(total("ingreso_con_cvg") / 1e9, 1).alias("ingreso_total_b"),
            F.round(F.avg("precio_medio_con_cvg"), 2).alias("precio_medio"),
            F.round(F.avg("t2m"), 2).alias("temp_prom"),
            F.round(F.avg("prectotcorr"), 2).alias("lluvia_prom"),
        )
    )


# ---- blocks, plants -----------------------------------------------------------------

def block_figures(income: DataFrame) -> DataFrame:
    """Mean tariff and sums by company, tariff and block; real blocks with a price only."""
    return (
        income.filter((F.col("bloque_consumo") != NO_BLOCK) & (F.col("tarifa_promedio") > 0))
        .groupBy("nombre_empresa", "tarifa", "bloque_consumo", "tipo_tarifa")
        .agg(
            F.avg("tarifa_promedio").alias("tarifa_promedio_avg"),
            F.sum("ventas_por_mes").alias("ventas_total"),
            F.sum("ingreso_con_cvg").alias("ingreso_total"),
        )
        .orderBy("tarifa", "bloque_consumo", "nombre_empresa", "tipo_tarifa")
    )


def block_means(blocks: DataFrame) -> DataFrame:
    """Mean of the grouped means by block, descending."""
    return (
        blocks.groupBy("bloque_consumo")
        .agg(F.avg("tarifa_promedio_avg").alias("tarifa_promedio"))
        .orderBy(F.col("tarifa_promedio").desc(), "bloque_consumo")
    )


def block_sales(blocks: DataFrame) -> DataFrame:
    """Rows (nombre_empresa, bloque_consumo, ventas_total): the matrix in long form."""
    return blocks.groupBy("nombre_empresa", "bloque_consumo").agg(F.sum("ventas_total").alias("ventas_total"))


def block_matrix(blocks: DataFrame, header: Sequence[str]) -> DataFrame:
    """Sales by company and the blocks named, empty cells as zero."""
    return matrix(blocks, "nombre_empresa", "bloque_consumo", header, F.sum("ventas_total"), 0)


def plants_by_province(plants: DataFrame) -> DataFrame:
    return (
        plants.filter(F.col("provincia").isNotNull())
        .groupBy("provincia")
        .agg(F.countDistinct("central_electrica").alias("centrales"))
        .orderBy(F.col("centrales").desc(), "provincia")
    )


def source_counts(plants: DataFrame) -> DataFrame:
    return plants.groupBy("nombre_empresa", "fuente").agg(
        F.countDistinct("central_electrica").alias("cantidad")
    )


def source_matrix(plants: DataFrame, header: Sequence[str]) -> DataFrame:
    """Mean of the counts by company and the sources named, empty cells as zero; long form: ``source_counts``."""
    cell = F.avg("cantidad")
    return matrix(source_counts(plants), "nombre_empresa", "fuente", header, cell, 0)


def sales_and_plants(df: DataFrame, per_company: DataFrame) -> DataFrame:
    """Total sales beside the number of plants, for companies with both."""
    sales = sales_by(df, "empresa").withColumnRenamed("empresa", "empresa_canonica")
    plants = per_company.select("empresa_canonica", "cantidad_centrales_asociadas")
    return sales.join(plants, "empresa_canonica")
