"""Report pages and a whole load, as rows (part, key, figure, value).

A page's SQL is put together from the SQL of the single reports.
"""

from functools import reduce

from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.checks import aggregates, profiling, standins as st, warehouse  # noqa: F401
from energy_mart.checks.profiling import CORRELATED, MEASURES, RANKED, base
from energy_mart.checks.registry import SQL, check
from energy_mart.functions.text import MONTH_LABELS
from energy_mart.plans import pages, star, views
from energy_mart.session import materialise, scratch_path

MONTHS = dict.fromkeys(MONTH_LABELS, 4)
CHANGE = {"mean_first": 4, "mean_second": 4, "change_pct": 6}
FIGURES = {"n": 0, "mean": 4, "std": 4, "min": 4, "q25": 4, "q50": 4, "q75": 4, "max": 4}


def long_rows(frame, part, keys, figures):
    """One row per key and figure, rounded."""
    cells = [
        F.struct(F.lit(c).alias("figure"), F.round(F.col(f"`{c}`").cast("double"), d).alias("value"))
        for c, d in figures.items()
    ]
    key = F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys]) if keys else F.lit("")
    rows = frame.select(F.lit(part).alias("part"), key.alias("key"), F.explode(F.array(*cells)).alias("c"))
    return rows.select("part", "key", "c.figure", "c.value")


def long_sql(sql, part, keys, figures):
    key = "concat_ws('|', " + ", ".join(f'CAST("{k}" AS VARCHAR)' for k in keys) + ")" if keys else "''"
    names = ", ".join(f"'{c}'" for c in figures)
    values = ", ".join(f'round(CAST("{c}" AS DOUBLE), {d})' for c, d in figures.items())
    return f"SELECT '{part}' AS part, {key} AS key, unnest([{names}]) AS figure, unnest([{values}]) AS value FROM ({sql})"


def stacked(page, parts):
    return reduce(
        lambda a, b: a.unionByName(b),
        [long_rows(page[part], part, keys, figures) for part, (_, keys, figures) in parts.items()],
    )


def page_sql(parts):
    return " UNION ALL ".join(
        long_sql(SQL.get(source, source), part, keys, figures) for part, (source, keys, figures) in parts.items()
    )


# Part -> (single report or SQL, key columns, figure -> decimals).
OVERVIEW = {
    "key_figures": ("a3_key_figures", (), {"ventas_total": 2, "precio_promedio": 6, "temperatura_promedio": 6}),
    "yearly_totals": ("a4_yearly_totals", ("ano",), {"ventas": 2, "ingreso": 2}),
    "market_share": ("a31_market_share", ("empresa",), {"ventas": 2, "share_pct": 6}),
    "company_months": ("a6_company_month_matrix", ("empresa",), MONTHS),
}


@check("r1_overview", page_sql(OVERVIEW))
def overview(spark, sf):
    return stacked(pages.overview(base(spark, sf)), OVERVIEW)


PANDEMIC = {
    "period_means": ("a8_period_means", ("periodo", "tarifa_label"), {"ventas": 4, "periodo_ord": 0}),
    "period_change": ("a8_period_change", ("tarifa_label",), {"antes": 4, "medio": 4, "despues": 4, "var_pct": 1}),
    "yearly_means": ("a9_yearly_tariff_means", ("ano", "tarifa"), {"ventas": 4}),
    "comparison": (
        f"""WITH {st.WIDE}, s AS (SELECT tarifa, avg(ventas) FILTER (WHERE ano IN (1995, 1996)) AS a,
        avg(ventas) FILTER (WHERE ano IN (1997, 1998)) AS b FROM base WHERE tarifa IN ('BUILDING', 'MACHINERY') GROUP BY tarifa)
        SELECT tarifa, a AS mean_first, b AS mean_second, (b - a) / a * 100 AS change_pct FROM s""",
        ("tarifa",), CHANGE,
    ),
}


@check("r2_pandemic", page_sql(PANDEMIC))
def pandemic(spark, sf):
    compared = ["BUILDING", "MACHINERY"]
    page = pages.pandemic(
        base(spark, sf), compared, [1995, 1996], [1997, 1998], st.LABELS, st.PERIODS, st.LAST_PERIOD
    )
    names = dict(zip([*st.PERIODS, st.LAST_PERIOD], ("antes", "medio", "despues")))
    page["period_change"] = page["period_change"].withColumnsRenamed(names)
    return stacked(page, PANDEMIC)


SUMMER = {
    "season_months": ("a10_season_months", ("estacion", "mes"), {"ventas": 4, "t2m": 6}),
    "month_means": (
        f"WITH {st.WIDE} SELECT mes, avg(ventas) AS ventas, avg(t2m) AS t2m FROM base GROUP BY mes",
        ("mes",), {"ventas": 4, "t2m": 6},
    ),
    "season_temperature": ("a11_season_temperature", ("empresa",), {"verano": 1, "lluvioso": 1, "diferencia": 1}),
    "season_comparison": ("a12_season_comparison", (), CHANGE),
    "trend": ("a20_trend", (), {"slope": 10, "intercept": 10, "corr": 8, "n": 0}),
}


@check("r3_summer", page_sql(SUMMER))
def summer(spark, sf):
    return stacked(pages.summer(base(spark, sf), "BUILDING"), SUMMER)


REGIONAL = {
    "figures": ("a12_regional_figures", (), {"t2m_first": 6, "t2m_second": 6, "ventas_verano": 4, "ventas_lluvioso": 4, "dif_pct": 6}),
    "temperatures": ("a13_company_month_means", ("empresa", "mes"), {"t2m": 6}),
    "sales": ("a5_sales_by_company", ("empresa",), {"ventas": 2}),
    "tariff_months": ("a7_tariff_month_matrix", ("tarifa",), MONTHS),
}


@check("r4_regional", page_sql(REGIONAL))
def regional(spark, sf):
    companies = ["NATION_1", "NATION_2", "NATION_7", "NATION_9"]
    return stacked(pages.regional(base(spark, sf), "NATION_1", "NATION_2", companies, "NATION_3"), REGIONAL)


EVOLUTION = {
    "monthly": ("a14_monthly_series", ("ano", "mes", "empresa", "fecha"), {"ventas": 2}),
    "sales": ("a5_sales_by_company", ("empresa",), {"ventas": 2}),
    "company_months": ("a6_company_month_matrix", ("empresa",), MONTHS),
}


@check("r5_evolution", page_sql(EVOLUTION))
def evolution(spark, sf):
    return stacked(pages.evolution(base(spark, sf)), EVOLUTION)


CLIMATE = {
    "correlations": ("a18_correlation_ranking", ("column",), {"corr": 8}),
    "strongest": ("a18_strongest", ("column", "side"), {"corr": 8}),
}


@check("r6_climate", page_sql(CLIMATE))
def climate(spark, sf):
    return stacked(pages.climate(base(spark, sf), RANKED), CLIMATE)


GEOGRAPHY = {
    "by_province": ("a22_plants_by_province", ("provincia",), {"centrales": 0}),
    "by_source": (
        f"WITH {st.PLANTS} SELECT operador AS nombre_empresa, fuente, count(DISTINCT central_electrica) AS cantidad FROM plants GROUP BY ALL",
        ("nombre_empresa", "fuente"), {"cantidad": 0},
    ),
    "by_company": (
        "v3_plants_per_company",
        ("empresa_canonica", "fuentes_electricas_agregadas", "centrales_electricas_agregadas"),
        {"cantidad_centrales_asociadas": 0},
    ),
}


@check("r7_geography", page_sql(GEOGRAPHY))
def geography(spark, sf):
    plants = warehouse._plant_list(spark, sf)
    return stacked(pages.geography(plants, views.plants_per_company(plants)), GEOGRAPHY)


EXPLORATION = {
    "described": ("a16_describe", ("column",), FIGURES),
    "seasonality": ("a15_seasonality", ("mes",), {"ventas": 4, "promedio_global": 4}),
    "correlations": ("a17_correlations_pairwise", ("a", "b"), {"corr": 8}),
    "prices": ("a30_top_tariff_prices", ("ano", "tarifa"), {"precio_medio_con_cvg": 6}),
    "summary": (
        "a24_company_summary", ("empresa",),
        {"registros": 0, "ventas_total_m": 1, "ventas_prom_m": 2, "ingreso_total_b": 1, "precio_medio": 2, "temp_prom": 2, "lluvia_prom": 2},
    ),
    "outliers": (
        f"""WITH {st.WIDE}, b AS (SELECT quantile_cont(t2m, 0.25) AS q1, quantile_cont(t2m, 0.75) AS q3 FROM base)
        SELECT 't2m' AS "column", any_value(q1 - (q3 - q1) * 1.5) AS low, any_value(q3 + (q3 - q1) * 1.5) AS high,
        count(*) FILTER (WHERE t2m < q1 - (q3 - q1) * 1.5 OR t2m > q3 + (q3 - q1) * 1.5) AS outliers FROM base, b""",
        ("column",), {"low": 6, "high": 6, "outliers": 0},
    ),
}


@check("r8_exploration", page_sql(EXPLORATION))
def exploration(spark, sf):
    df = materialise(base(spark, sf))
    page = pages.exploration(df, MEASURES, ("t2m",), ("t2m",), (), CORRELATED, 3)
    return stacked(page, EXPLORATION)


# ---- a whole load, read back by natural keys ------------------------------------------

def _stored(*names):
    """Measures as facts keep them."""
    return ", ".join(f"CAST(CAST({n} AS DECIMAL(18,6)) AS DOUBLE) AS {n}" for n in names)


CLIMATE_SHOWN = ("t2m", "ws10m", "cloud_amt", "t2m_max", "ps")
PRICES_SHOWN = ("abonados", "ventas", "ingreso_con_cvg", "precio_medio_con_cvg")
FUELS_SHOWN = schemas.FUEL_MEASURES
LOADED = {
    "fact_clima_mensual": (
        f"WITH {st.STAGED} SELECT make_date(ano, mes, 1) AS fecha, empresa AS nombre_empresa, {_stored(*CLIMATE_SHOWN)} FROM stg_climate",
        ("fecha", "nombre_empresa"), dict.fromkeys(CLIMATE_SHOWN, 6),
    ),
    "fact_tarifa_electricidad": (
        f"WITH {st.STAGED} SELECT make_date(ano, mes, 1) AS fecha, empresa AS nombre_empresa, tarifa AS nombre_tarifa, sistema, {_stored(*PRICES_SHOWN)} FROM stg_prices",
        ("fecha", "nombre_empresa", "nombre_tarifa", "sistema"),
        dict.fromkeys(PRICES_SHOWN, 6),
    ),
    "fact_distribucion_tarifaria": (
        f"WITH {st.STAGED} SELECT make_date(anho, id_mes, 1) AS fecha, empresa AS nombre_empresa, descripcion_tarifa, tipo_tarifa, bloque, {_stored('tarifa_promedio')} FROM stg_dist",
        ("fecha", "nombre_empresa", "descripcion_tarifa", "tipo_tarifa", "bloque"), {"tarifa_promedio": 6},
    ),
    "fact_hidrocarburos": (
        f"WITH {st.STAGED} SELECT fecha_publicacion AS fecha, producto, numero_expediente, numero_resolucion, {_stored(*FUELS_SHOWN)} FROM stg_fuels",
        ("fecha", "producto", "numero_expediente", "numero_resolucion"), dict.fromkeys(FUELS_SHOWN, 6),
    ),
    "dim_central_electrica": (
        f"WITH {st.STAGED} SELECT id_objecto, operador, central_electrica, fuente, provincia, canton, codigo_dta FROM plants",
        ("id_objecto", "operador", "central_electrica", "fuente", "provincia", "canton"), {"codigo_dta": 0},
    ),
    "dim_zona_concesion": (
        f"WITH {st.STAGED} SELECT id_objecto, operador, descripcion, area FROM zones",
        ("id_objecto", "operador", "descripcion"), {"area": 4},
    ),
    "bridge_empresa_zona": (
        f"WITH {st.STAGED}, {warehouse.COMPANIES} SELECT id_objecto, n AS nombre_empresa, 1 AS links FROM zones JOIN (SELECT nombre_empresa AS n FROM companies UNION SELECT trim(operador) FROM zones) ON upper(n) = upper(trim(operador))",
        ("id_objecto", "nombre_empresa"), {"links": 0},
    ),
}


@check("e1_loaded_rows", page_sql(LOADED))
def loaded_rows(spark, sf):
    """Rows of the facts, plants, zones and links that two loads in a row leave, by natural keys."""
    staged = st.staging(spark, sf)
    target = star.Star(spark, scratch_path(spark, "star"))
    for _ in range(2):
        target.load(staged)
    dims = {name: target.read(name) for name in schemas.DIMENSIONS}
    dates = dims["dim_tiempo"].select("tiempo_key", "fecha")
    tables = {}
    for name, (_, grain, _) in schemas.FACTS.items():
        rows = target.read(name).join(dates, "tiempo_key")
        for dim, key in (
            ("dim_empresa", "empresa_key"), ("dim_tarifa", "tarifa_key"),
            ("dim_producto_hidrocarburo", "producto_key"), ("dim_resolucion_hidrocarburo", "resolucion_key"),
        ):
            if key in grain:
                rows = rows.join(dims[dim].drop("fecha_publicacion"), key)
        tables[name] = rows
    tables["dim_central_electrica"] = dims["dim_central_electrica"].join(dims["dim_ubicacion"], "ubicacion_key")
    tables["dim_zona_concesion"] = dims["dim_zona_concesion"]
    links = target.read("bridge_empresa_zona").withColumn("links", F.lit(1))
    tables["bridge_empresa_zona"] = links.join(dims["dim_empresa"], "empresa_key").join(dims["dim_zona_concesion"], "zona_key")
    return stacked(tables, LOADED)


@check("k4_failed_load", f"""
WITH {st.STAGED}, {warehouse.DATES}
SELECT 'dim_tiempo' AS objeto, count(*) AS filas FROM dates
UNION ALL SELECT 'fact_tarifa_electricidad', count(*) FROM stg_prices
UNION ALL SELECT 'dim_zona_concesion', count(*) FROM zones
""")
def failed_load(spark, sf):
    """A load that stops at its last step leaves every table as the load before left it."""
    staged = dict(st.staging(spark, sf))
    target = star.Star(spark, scratch_path(spark, "star"))
    target.load(staged)
    zones = staged["stg_zonas"]
    broken = {**staged, "stg_zonas": zones.unionByName(zones.withColumn("descripcion", F.lit("otra")))}
    try:
        target.load(broken)
    except ValueError:
        pass
    else:
        raise AssertionError("a load with two rows for one zone must stop")
    names = ("dim_tiempo", "fact_tarifa_electricidad", "dim_zona_concesion")
    counts = [target.read(n).agg(F.lit(n).alias("objeto"), F.count(F.lit(1)).alias("filas")) for n in names]
    return reduce(lambda a, b: a.unionByName(b), counts)
