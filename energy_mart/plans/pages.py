"""The eight report pages: one function each, giving named tables from one shared base frame.

``df`` is ``reports.base``: settle it once and pass it to every page. The three hypothesis pages take
the unfiltered frame, the others what the reader's filter leaves. Nothing is computed until a table is used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from energy_mart.functions import text
from energy_mart.functions.dates import LAST_PERIOD, PERIODS
from energy_mart.operators import profile
from energy_mart.plans import reports as r

Page = dict[str, DataFrame]


def overview(df: DataFrame, top: int = 5) -> Page:
    return {
        "key_figures": r.key_figures(df),
        "yearly_totals": r.yearly_totals(df),
        "market_share": r.market_share(df, top),
        "company_months": r.company_month_matrix(df),
    }


def pandemic(
    df: DataFrame,
    compared: Sequence[str] = (r.RESIDENTIAL, r.COMMERCE),
    first_years: Sequence[int] = (2020, 2021),
    second_years: Sequence[int] = (2022, 2023),
    labels: Mapping[str, str] = text.TARIFF_LABELS,
    periods: r.Periods = PERIODS,
    last_period: str = LAST_PERIOD,
) -> Page:
    return {
        "period_means": r.period_means(df, labels, periods, last_period),
        "period_change": r.period_change(df, labels, periods, last_period),
        "yearly_means": r.yearly_tariff_means(df, compared),
        "comparison": r.tariff_comparison(df, compared, first_years, second_years),
    }


def summer(df: DataFrame, tariff: str = r.RESIDENTIAL) -> Page:
    return {
        "season_months": r.season_months(df, tariff),
        "month_means": r.month_means(df),
        "season_temperature": r.season_temperature(df),
        "season_comparison": r.season_comparison(df),
        "trend": r.temperature_trend(df, tariff),
    }


def regional(
    df: DataFrame,
    warm: str = r.WARM_COMPANY,
    valley: str = r.VALLEY_COMPANY,
    companies: Sequence[str] = r.TEMPERATURE_COMPANIES,
    tariffs_of: str | None = None,
) -> Page:
    return {
        "figures": r.regional_figures(df, warm, valley),
        "temperatures": r.company_month_means(df, companies, "t2m"),
        "sales": r.sales_by(df, "empresa", True),
        "tariff_months": r.tariff_month_matrix(df, tariffs_of or warm),
    }


def evolution(df: DataFrame, companies: Sequence[str] | None = None) -> Page:
    return {
        "monthly": r.monthly_series(df, companies),
        "sales": r.sales_by(df, "empresa", True),
        "company_months": r.company_month_matrix(df),
    }


def climate(df: DataFrame, names: Sequence[str] = r.CLIMATE_PAGE, chosen: str = "t2m") -> Page:
    ranked = r.climate_correlations(df, names)
    return {
        "correlations": ranked,
        "strongest": r.strongest(ranked),
        "trend_points": r.climate_trend_points(df, chosen, names),
    }


def geography(plants: DataFrame, per_company: DataFrame) -> Page:
    return {
        "by_province": r.plants_by_province(plants),
        "by_source": r.source_counts(plants),
        "by_company": per_company,
    }


def exploration(
    df: DataFrame,
    described: Sequence[str] = r.DESCRIBED,
    bounded: Sequence[str] = r.OUTLIER_COLUMNS,
    boxed: Sequence[str] = r.BOX_COLUMNS,
    binned: Sequence[str] = r.HISTOGRAM_COLUMNS,
    correlated: Sequence[str] = r.CORRELATED,
    top: int = 5,
) -> Page:
    """Profile, distributions and summaries; the histograms read the ends of their columns at once."""
    tables = {
        "metrics": profile.dataset_metrics(df),
        "nulls": profile.null_shares(df),
        "described": profile.describe(df, described),
        "outliers": profile.outlier_summary(df, bounded),
        "boxes": profile.box_figures(df, boxed),
        "seasonality": r.seasonality(df),
        "correlations": profile.correlations(df, correlated),
        "prices": r.top_tariff_prices(df, top),
        "summary": r.company_summary(df),
    }
    return tables | {f"histogram_{name}": profile.histogram(df, name) for name in binned}
