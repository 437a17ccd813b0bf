"""Views over the star schema, rebuilt from their column contracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.functions.text import company_code
from energy_mart.plans.star import Star

NO_BLOCK = "SIN BLOQUE ASOCIADO"

# View names used by the reports.
PLANT_VIEW = "vw_modelo_predictivo_central_tarifa_mensual"
INCOME_VIEW = "vw_ingresos_empresas_tarifas_mensual"
COMPANY_VIEW = "vw_empresa_centrales_agregadas"


def plant_list(dims: Mapping[str, DataFrame], code: Column | None = None) -> DataFrame:
    """Distinct company / plant / location rows, for plants whose operator is a company."""
    plants = dims["dim_central_electrica"].join(dims["dim_ubicacion"], "ubicacion_key")
    name = company_code(F.col("operador")) if code is None else code
    plants = plants.withColumn("nombre_empresa", name)
    return (
        plants.join(dims["dim_empresa"].select("nombre_empresa"), "nombre_empresa")
        .select(
            "nombre_empresa", "provincia", "canton", "central_electrica", "fuente", "operador",
            "coordenada_x", "coordenada_y",
        )
        .distinct()
    )


def monthly_income(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Monthly income by company, tariff and block.

    Sales repeat for every block of a tariff, so a sum over blocks counts them again.
    """
    tariffs = tables["dim_tarifa"]
    named = tables["fact_tarifa_electricidad"].join(
        tariffs.select("tarifa_key", F.col("nombre_tarifa").alias("tarifa")), "tarifa_key"
    )
    blocks = tables["fact_distribucion_tarifaria"].join(
        tariffs.select(
            "tarifa_key",
            F.col("nombre_tarifa").alias("tarifa"),
            F.col("bloque").alias("bloque_consumo"),
            F.col("tipo_tarifa").alias("tipo_tarifa"),
        ),
        "tarifa_key",
    )
    joined = named.select(
        "tiempo_key", "empresa_key", "tarifa", "ventas", "ingreso_con_cvg"
    ).join(
        blocks.select(
            "tiempo_key", "empresa_key", "tarifa", "bloque_consumo", "tipo_tarifa",
            "tarifa_promedio",
        ),
        ["tiempo_key", "empresa_key", "tarifa"],
        "left",
    )
    return (
        joined.join(tables["dim_empresa"], "empresa_key")
        .join(tables["dim_tiempo"].select("tiempo_key", "anio", "mes"), "tiempo_key")
        .select(
            "nombre_empresa", "anio", "mes", "tarifa",
            F.coalesce("bloque_consumo", F.lit(NO_BLOCK)).alias("bloque_consumo"),
            "tipo_tarifa", "tarifa_promedio",
            F.col("ventas").alias("ventas_por_mes"), "ingreso_con_cvg",
        )
    )


def company_facets(plants: DataFrame) -> DataFrame:
    """Distinct rows (empresa_canonica, clase, valor): the lists of ``plants_per_company``, unbounded."""
    kinds = [
        F.struct(F.lit(k).alias("clase"), F.col(k).alias("valor"))
        for k in ("fuente", "central_electrica", "operador")
    ]
    rows = plants.select(F.col("nombre_empresa").alias("empresa_canonica"), F.explode(F.array(*kinds)).alias("k"))
    return rows.select("empresa_canonica", "k.*").filter(F.col("valor").isNotNull()).distinct()


def plants_per_company(plants: DataFrame) -> DataFrame:
    """Plant count and the sorted distinct sources, plants and operators of each company, as text.

    The text of a company grows with its plants; ``company_facets`` has the same in rows.
    """
    def joined(name: str, out: str) -> Column:
        return F.array_join(F.sort_array(F.collect_set(name)), ", ").alias(out)

    return plants.groupBy(F.col("nombre_empresa").alias("empresa_canonica")).agg(
        F.countDistinct("central_electrica").alias("cantidad_centrales_asociadas"),
        joined("fuente", "fuentes_electricas_agregadas"),
        joined("central_electrica", "centrales_electricas_agregadas"),
        joined("operador", "operadores_centrales_agregados"),
    )


def register_views(star: Star) -> None:
    """Temporary views under the published names."""
    tables = {name: star.read(name) for name in star.tables()}
    plants = plant_list(tables)
    plants.createOrReplaceTempView(PLANT_VIEW)
    monthly_income(tables).createOrReplaceTempView(INCOME_VIEW)
    plants_per_company(plants).createOrReplaceTempView(COMPANY_VIEW)
