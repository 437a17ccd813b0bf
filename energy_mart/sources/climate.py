"""Climate: monthly CSV and landed JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_mart.functions.dates import is_yearly_key
from energy_mart.functions.numbers import lenient_double, lenient_int, sentinel_to_null
from energy_mart.functions.text import clean_key
from energy_mart.operators.project import trim_names
from energy_mart.operators.quality import split_rejects
from energy_mart.schemas import CLIMATE_VARIABLES
from energy_mart.sources.files import read_csv

SERIES = "$.properties.parameter"
# Kinds of JSON values that stand for a measure; VOID is null.
_NUMBER = r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT|VOID)$"
_MONTH_KEY = r"^[0-9]{6}$"


def clean_climate_keys(df: DataFrame) -> DataFrame:
    """Trimmed upper-case company, whole year and month, numeric measures.

    Rows missing one of the keys go.
    """
    rows = trim_names(df)
    changes = {
        "Empresa": clean_key(F.col("Empresa").cast("string")),
        "Año": lenient_int(F.col("Año")),
        "Mes": lenient_int(F.col("Mes")),
    }
    changes |= {v: lenient_double(F.col(v)) for v in CLIMATE_VARIABLES if v in rows.columns}
    return rows.withColumns(changes).dropna(subset=["Empresa", "Año", "Mes"])


def read_climate(spark: SparkSession, path: str) -> DataFrame:
    return clean_climate_keys(read_csv(spark, path))


def _series(payload: Column, kind: str) -> Column:
    """Variable -> key -> value; null if the payload has no such object."""
    return F.try_variant_get(F.try_parse_json(payload), SERIES, f"map<string,map<string,{kind}>>")


def payload_rules(payload: Column) -> dict[str, Column]:
    """Why a payload cannot be read; a payload breaks one rule at most, or gives all its cells."""
    raw = _series(payload, "variant")
    series, text = F.map_values(raw), F.coalesce(payload, F.lit(""))
    no_object = F.exists(series, lambda s: s.isNull())
    strange_key = F.exists(series, lambda s: F.exists(F.map_keys(s), lambda k: ~k.rlike(_MONTH_KEY)))
    no_number = F.exists(series, lambda s: F.exists(F.map_values(s), lambda v: ~F.schema_of_variant(v).rlike(_NUMBER)))
    found, rules, open_ = {
        "no payload": F.trim(text) == "",
        "not JSON": F.try_parse_json(payload).isNull(),
        "no series of variables": raw.isNull(),
        "a variable without a series": no_object,
        "a key that is not a month": strange_key,
        "a value that is not a number": no_number,
    }, {}, F.lit(True)
    for reason, broken in found.items():
        broken = F.coalesce(broken, F.lit(False))
        rules[reason] = open_ & broken
        open_ = open_ & ~broken
    return rules


def split_payloads(df: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(rows whose payload can be read whole, the others with their reasons); both have all columns of ``df``."""
    return split_rejects(df, payload_rules(F.col(payload)))


def payload_cells(df: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Rows (*keep, variable, ym, value); the yearly key (month 13) is left out.

    Of the payloads that ``split_payloads`` accepts; a payload with any part that cannot be read has no rows here.
    """
    readable, _ = split_payloads(df, payload)
    series = readable.select(*keep, F.explode(_series(F.col(payload), "double")).alias("variable", "s"))
    cells = series.select(*keep, "variable", F.explode("s").alias("ym", "value"))
    return cells.filter(~is_yearly_key(F.col("ym")))


def monthly_climate(
    df: DataFrame,
    payload: str = "payload",
    company: str = "empresa",
    variables: Sequence[str] = CLIMATE_VARIABLES,
) -> DataFrame:
    """One row per company and month: mean of each variable over the company's points.

    Variables are matched by key and the missing-value sentinel is removed before the mean.
    """
    cells = payload_cells(df, payload, [company])
    value = sentinel_to_null(F.col("value"))
    means = [
        F.avg(F.when(F.col("variable") == v, value)).alias(v) for v in variables
    ]
    return cells.groupBy(
        F.col(company).alias("Empresa"),
        F.substring("ym", 1, 4).cast("int").alias("Año"),
        F.substring("ym", 5, 2).cast("int").alias("Mes"),
    ).agg(*means)
