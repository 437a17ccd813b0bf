"""The two whole runs: landed files to the wide dataset, and landed frames to the star."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_mart.operators import quality
from energy_mart.operators.project import stack_by_name, to_model
from energy_mart.plans import recipes
from energy_mart.plans.star import Star
from energy_mart.schemas import STAGING
from energy_mart.session import materialise
from energy_mart.sources.climate import clean_climate_keys, read_climate
from energy_mart.sources.files import read_csv_files, write_csv
from energy_mart.sources.tables import Staging, refresh_catalogs

# Names of the two derived files.
PRICES_FILE = "aresep_unificado_2020_2025.csv"
WIDE_FILE = "dataset_final_2020_2025.csv"

PREPARE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "stg_hidrocarburos": lambda raw: recipes.prepare_fuels(recipes.typed_fuels(raw)),
    "stg_centro": recipes.prepare_plants,
    "stg_zonas": recipes.prepare_zones,
    "stg_distribucion": recipes.prepare_distribution,
    "stg_aresep_medios": lambda raw: recipes.prepare_prices(recipes.clean_prices(raw)),
    "stg_clima_nasa": lambda raw: recipes.prepare_climate(clean_climate_keys(raw)),
}


class WideDataset(NamedTuple):
    prices: DataFrame
    climate: DataFrame
    wide: DataFrame
    reconciliation: DataFrame


def wide_dataset(spark: SparkSession, prices: str, climate: str, out: str) -> WideDataset:
    """Read, reconcile (on the raw rows), clean, join, and write the two derived files."""
    raw = read_csv_files(spark, prices)
    cleaned = materialise(recipes.clean_prices(raw))
    weather = read_climate(spark, climate)
    wide = recipes.wide_table(cleaned, weather)
    write_csv(cleaned, f"{out.rstrip('/')}/{PRICES_FILE}")
    write_csv(wide, f"{out.rstrip('/')}/{WIDE_FILE}")
    return WideDataset(cleaned, weather, wide, recipes.price_reconciliation(raw))


# Source columns that identify a row; of several rows for one, the first landed is kept.
UNIQUE: dict[str, list[str]] = {"stg_zonas": ["id_Objecto"]}


def stage(area: Staging, name: str, prepared: DataFrame) -> DataFrame:
    """Append the rows that fit the staging model; the others become the run's rejects.

    One summary row: table, total, accepted, rejected.
    """
    rules = quality.source_rules(prepared, STAGING[name])
    marked = materialise(quality.with_reasons(prepared, rules))
    good = F.size(quality.REASONS) == 0
    fitting, rejected = marked.filter(good), marked.filter(~good)
    if name in UNIQUE:
        place = fitting.withColumn("__at", F.monotonically_increasing_id())
        fitting, later = quality.split_repeated(materialise(place), UNIQUE[name], "__at")
        fitting, rejected = fitting.drop("__at"), rejected.unionByName(later.drop("__at"))
    fitting, rejected = materialise(fitting.drop(quality.REASONS)), materialise(rejected)
    area.append(name, to_model(fitting, STAGING[name]))
    area.reject(name, rejected)
    counts = fitting.select(F.lit(True).alias("ok")).unionByName(rejected.select(F.lit(False).alias("ok")))
    return counts.agg(
        F.lit(name).alias("table"),
        F.count(F.lit(1)).alias("total"),
        F.count_if("ok").alias("accepted"),
        F.count_if(~F.col("ok")).alias("rejected"),
    )


def full_load(
    spark: SparkSession,
    landed: Mapping[str, DataFrame],
    root: str,
    catalogs: str | None = None,
    update_facts: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Refresh the dictionaries, empty staging, prepare and stage each landed frame, load the star.

    ``landed`` maps staging tables to raw frames, ``catalogs`` is the folder of dictionary
    files, if there are any. Returns (staging summary, load audit); ``Star.losses`` lists what lookups lost and
    which columns were left out.
    """
    root = root.rstrip("/")
    if catalogs is not None:
        refresh_catalogs(spark, catalogs, f"{root}/catalogs").collect()  # a row per file
    area = Staging(spark, f"{root}/staging")
    area.clear()
    prepared = {name: PREPARE[name](raw) for name, raw in landed.items()}
    dropped = [
        (name, f.source) for name, df in prepared.items() for f in STAGING[name]
        if f.source in landed[name].columns and f.source not in df.columns
    ]
    summary = stack_by_name([stage(area, name, df) for name, df in prepared.items()])
    loaded = {name: area.read(name) for name in STAGING}
    audit = Star(spark, f"{root}/star").load(loaded, update_facts, dropped)
    return summary, audit
