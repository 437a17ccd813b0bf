"""Star schema, views and the reports on them."""

from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.checks import standins as st
from energy_mart.checks.profiling import base, rounded
from energy_mart.checks.registry import check
from energy_mart.operators.merge import first_by, upsert
from energy_mart.plans import reports, star, views
from energy_mart.session import scratch_path

PRICES_ONLY = ("stg_aresep_medios",)
DATED = ("stg_clima_nasa", "stg_aresep_medios", "stg_distribucion", "stg_hidrocarburos")

DATES = """
dates AS (
  SELECT make_date(ano, mes, 1) AS fecha FROM stg_prices UNION SELECT make_date(ano, mes, 1) FROM stg_climate
  UNION SELECT make_date(anho, id_mes, 1) FROM stg_dist UNION SELECT fecha_publicacion FROM stg_fuels
)
"""
COMPANIES = """
companies AS (
  SELECT empresa AS nombre_empresa FROM stg_prices UNION SELECT empresa FROM stg_climate
  UNION SELECT empresa FROM stg_dist
)
"""
TARIFFS = """
tariffs AS (
  SELECT DISTINCT 'MEDIOS|' || tarifa || '|' || sistema || '|' AS tarifa_nk, tarifa AS nombre_tarifa,
    CAST(NULL AS VARCHAR) AS tipo_tarifa, CAST(NULL AS VARCHAR) AS descripcion_tarifa,
    CAST(NULL AS VARCHAR) AS bloque, sistema, CAST(NULL AS VARCHAR) AS indicador_trimestral
  FROM stg_prices
  UNION SELECT DISTINCT 'DISTRIBUCION|' || tipo_tarifa || '|' || descripcion_tarifa || '|' || bloque || '|||',
    descripcion_tarifa, tipo_tarifa, descripcion_tarifa, bloque, NULL, NULL
  FROM stg_dist
)
"""


@check("w1_dim_tiempo", f"""
WITH {st.STAGED}, {DATES}
SELECT row_number() OVER (ORDER BY fecha) AS tiempo_key, fecha,
  CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
  CAST(day(fecha) AS INTEGER) AS dia, CAST(quarter(fecha) AS INTEGER) AS trimestre,
  upper(month_name[1]) || lower(month_name[2:]) AS nombre_mes,
  CAST(year(fecha) * 100 + month(fecha) AS INTEGER) AS anio_mes
FROM dates JOIN month_names ON m = month(fecha)
""")
def dim_tiempo(spark, sf):
    return star.dimension(star.date_rows(st.staging(spark, sf, DATED)), "dim_tiempo")


@check("w2_dim_empresa", f"""
WITH {st.STAGED}, {COMPANIES}
SELECT row_number() OVER (ORDER BY nombre_empresa) AS empresa_key, nombre_empresa FROM companies
""")
def dim_empresa(spark, sf):
    return star.dimension(star.company_rows(st.staging(spark, sf, DATED[:3])), "dim_empresa")


@check("w3_dim_tarifa", f"""
WITH {st.STAGED}, {TARIFFS}
SELECT row_number() OVER (ORDER BY tarifa_nk) AS tarifa_key, * FROM tariffs
""")
def dim_tarifa(spark, sf):
    return star.dimension(star.tariff_rows(st.staging(spark, sf, DATED[1:3])), "dim_tarifa")


@check("w4_w5_plants", f"""
WITH {st.STAGED}
SELECT id_objecto, operador, central_electrica, fuente, provincia, canton, codigo_dta FROM plants
""")
def plants(spark, sf):
    staged = st.staging(spark, sf, ("stg_centro",))
    locations = star.dimension(star.location_rows(staged), "dim_ubicacion")
    keyed = star.dimension(star.plant_rows(staged, locations), "dim_central_electrica")
    return keyed.join(locations, "ubicacion_key").select(
        "id_objecto", "operador", "central_electrica", "fuente", "provincia", "canton", "codigo_dta"
    )


@check("w6_dim_producto", f"""
WITH {st.STAGED}
SELECT row_number() OVER (ORDER BY producto) AS producto_key, producto
FROM (SELECT DISTINCT producto FROM stg_fuels)
""")
def dim_producto(spark, sf):
    rows = star.product_rows(st.staging(spark, sf, ("stg_hidrocarburos",)))
    return star.dimension(rows, "dim_producto_hidrocarburo")


@check("w7_dim_resolucion", f"""
WITH {st.STAGED}, r AS (
  SELECT DISTINCT numero_expediente || '|' || numero_resolucion || '|' || strftime(fecha_publicacion, '%Y-%m-%d')
    AS resolucion_nk, numero_expediente, numero_resolucion, fecha_publicacion, 'ALCANCE' AS alcance_gaceta,
    numero_gaceta, rige FROM stg_fuels
)
SELECT row_number() OVER (ORDER BY resolucion_nk) AS resolucion_key, * FROM r
""")
def dim_resolucion(spark, sf):
    rows = star.resolution_rows(st.staging(spark, sf, ("stg_hidrocarburos",)))
    return star.dimension(rows, "dim_resolucion_hidrocarburo")


def _dims(staged, *names):
    build = {
        "dim_tiempo": star.date_rows,
        "dim_empresa": star.company_rows,
        "dim_tarifa": star.tariff_rows,
        "dim_producto_hidrocarburo": star.product_rows,
        "dim_resolucion_hidrocarburo": star.resolution_rows,
    }
    return {name: star.dimension(build[name](staged), name) for name in names}


def _with_names(facts, dims):
    out = facts.join(dims["dim_tiempo"].select("tiempo_key", "fecha"), "tiempo_key")
    return out.join(dims["dim_empresa"], "empresa_key")


@check("w8_fact_climate", f"""
WITH {st.STAGED}
SELECT make_date(ano, mes, 1) AS fecha, empresa AS nombre_empresa,
  CAST(CAST(t2m AS DECIMAL(18,6)) AS DOUBLE) AS t2m, ws10m, cloud_amt, t2m_max, ps FROM stg_climate
""")
def fact_climate(spark, sf):
    staged = st.staging(spark, sf, ("stg_clima_nasa",))
    dims = _dims(staged, "dim_tiempo", "dim_empresa")
    rows = _with_names(star.climate_facts(staged, dims), dims)
    measures = ("t2m", "ws10m", "cloud_amt", "t2m_max", "ps")
    return rows.select("fecha", "nombre_empresa", *[F.col(m).cast("double").alias(m) for m in measures])


FACT_PRICES = f"""
WITH {st.PRICES}, d AS (SELECT DISTINCT make_date(ano, mes, 1) AS fecha FROM stg_prices),
e AS (SELECT DISTINCT empresa FROM stg_prices),
t AS (SELECT DISTINCT tarifa, sistema FROM stg_prices),
dk AS (SELECT *, row_number() OVER (ORDER BY fecha) AS tiempo_key FROM d),
ek AS (SELECT *, row_number() OVER (ORDER BY empresa) AS empresa_key FROM e),
tk AS (SELECT *, row_number() OVER (ORDER BY 'MEDIOS|' || tarifa || '|' || sistema || '|') AS tarifa_key FROM t),
f AS (
  SELECT tiempo_key, empresa_key, tarifa_key, abonados, ventas, ingreso_con_cvg, precio_medio_con_cvg
  FROM stg_prices JOIN dk ON fecha = make_date(ano, mes, 1) JOIN ek USING (empresa) JOIN tk USING (tarifa, sistema)
)
"""


@check("w9_fact_tariff", f"""
{FACT_PRICES}
SELECT row_number() OVER (ORDER BY tiempo_key, empresa_key, tarifa_key) AS fact_tarifa_key, * FROM f
""")
def fact_tariff(spark, sf):
    staged = st.staging(spark, sf, PRICES_ONLY)
    dims = _dims(staged, "dim_tiempo", "dim_empresa", "dim_tarifa")
    facts = star.price_facts(staged, dims)
    keyed = star.with_keys(facts, None, "fact_tarifa_key", ["tiempo_key", "empresa_key", "tarifa_key"])
    measures = ("abonados", "ventas", "ingreso_con_cvg", "precio_medio_con_cvg")
    return keyed.select(
        "fact_tarifa_key", "tiempo_key", "empresa_key", "tarifa_key",
        *[F.col(m).cast("double").alias(m) for m in measures],
    )


@check("w10_fact_distribution", f"""
WITH {st.STAGED}
SELECT make_date(anho, id_mes, 1) AS fecha, empresa AS nombre_empresa, tipo_tarifa, descripcion_tarifa,
  bloque, CAST(CAST(tarifa_promedio AS DECIMAL(18,6)) AS DOUBLE) AS tarifa_promedio FROM stg_dist
""")
def fact_distribution(spark, sf):
    staged = st.staging(spark, sf, ("stg_distribucion",))
    dims = _dims(staged, "dim_tiempo", "dim_empresa", "dim_tarifa")
    rows = _with_names(star.distribution_facts(staged, dims), dims).join(dims["dim_tarifa"], "tarifa_key")
    return rows.select(
        "fecha", "nombre_empresa", "tipo_tarifa", "descripcion_tarifa", "bloque",
        F.col("tarifa_promedio").cast("double").alias("tarifa_promedio"),
    )


@check("w11_fact_fuels", f"""
WITH {st.STAGED}
SELECT fecha_publicacion, producto, numero_expediente, numero_resolucion, {", ".join(schemas.FUEL_MEASURES)}
FROM stg_fuels
""")
def fact_fuels(spark, sf):
    staged = st.staging(spark, sf, ("stg_hidrocarburos",))
    dims = _dims(staged, "dim_tiempo", "dim_producto_hidrocarburo", "dim_resolucion_hidrocarburo")
    rows = (
        star.fuel_facts(staged, dims)
        .join(dims["dim_producto_hidrocarburo"], "producto_key")
        .join(dims["dim_resolucion_hidrocarburo"], "resolucion_key")
    )
    return rows.select(
        "fecha_publicacion", "producto", "numero_expediente", "numero_resolucion",
        *[F.col(m).cast("double").alias(m) for m in schemas.FUEL_MEASURES],
    )


LOAD = f"""
WITH {st.STAGED}, {DATES}, {COMPANIES}, {TARIFFS}, counts AS (
  SELECT 1 AS step, 'dim_tiempo' AS objeto, (SELECT count(*) FROM dates) AS n
  UNION ALL SELECT 2, 'dim_empresa', (SELECT count(*) FROM companies)
  UNION ALL SELECT 3, 'dim_tarifa', (SELECT count(*) FROM tariffs)
  UNION ALL SELECT 4, 'dim_ubicacion', (SELECT count(*) FROM (SELECT DISTINCT provincia, canton, codigo_dta, x, y FROM plants))
  UNION ALL SELECT 5, 'dim_central_electrica', (SELECT count(*) FROM plants)
  UNION ALL SELECT 6, 'dim_producto_hidrocarburo', (SELECT count(DISTINCT producto) FROM stg_fuels)
  UNION ALL SELECT 7, 'dim_resolucion_hidrocarburo', (SELECT count(*) FROM
    (SELECT DISTINCT numero_expediente, numero_resolucion, fecha_publicacion FROM stg_fuels))
  UNION ALL SELECT 8, 'fact_clima_mensual', (SELECT count(*) FROM stg_climate)
  UNION ALL SELECT 9, 'fact_tarifa_electricidad', (SELECT count(*) FROM stg_prices)
  UNION ALL SELECT 10, 'fact_distribucion_tarifaria', (SELECT count(*) FROM stg_dist)
  UNION ALL SELECT 11, 'fact_hidrocarburos', (SELECT count(*) FROM stg_fuels)
  UNION ALL SELECT 12, 'dim_empresa_zonas', (SELECT count(*) FROM (SELECT DISTINCT trim(operador) AS o FROM zones)
    WHERE o NOT IN (SELECT nombre_empresa FROM companies))
  UNION ALL SELECT 13, 'dim_zona_concesion', (SELECT count(*) FROM zones)
  UNION ALL SELECT 14, 'bridge_empresa_zona', (SELECT count(*) FROM zones JOIN
    (SELECT nombre_empresa FROM companies UNION SELECT trim(operador) FROM zones) ON upper(nombre_empresa) = upper(trim(operador)))
)
SELECT CAST(run AS INTEGER) AS run, CAST(step AS INTEGER) AS step, objeto,
  CASE WHEN run = 2 AND step <> 13 THEN 0 ELSE n END AS filas_insertadas
FROM counts CROSS JOIN range(1, 3) r(run)
"""


@check("w_load_twice", LOAD)
def load_twice(spark, sf):
    """The whole load, then again: the second run only refreshes zones."""
    staged = st.staging(spark, sf)
    target = star.Star(spark, scratch_path(spark, "star"))
    runs = [target.load(staged).withColumn("run", F.lit(i)) for i in (1, 2)]
    return runs[0].unionByName(runs[1]).select("run", "step", "objeto", "filas_insertadas")


@check("w13_zone_upsert", f"""
WITH {st.ZONES}
SELECT row_number() OVER (ORDER BY id_objecto) AS zona_key, id_objecto,
  CASE WHEN id_objecto % 2 = 0 THEN NULL ELSE descripcion END AS descripcion FROM zones
""")
def zone_upsert(spark, sf):
    """Even zones are loaded again with a null description, which must win; keys stay."""
    staged = st.staging(spark, sf, ("stg_zonas",))
    first = star.dimension(star.zone_rows(staged), "dim_zona_concesion")
    changed = star.zone_rows(staged).filter("id_objecto % 2 = 0").withColumn(
        "descripcion", F.lit(None).cast("string")
    )
    merged = upsert(first, changed, ["id_objecto"], kept=["zona_key"])
    return merged.select("zona_key", "id_objecto", "descripcion")


@check("w_first_wins", """
SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1
""")
def first_wins(spark, sf):
    rows = st.table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    return first_by(rows, ["o_custkey", "o_orderpriority"])


@check("w14_bridge", f"""
WITH {st.ZONES}
SELECT id_objecto, n AS nombre_empresa, 'OPERADOR' AS fuente_vinculo
FROM zones JOIN (SELECT DISTINCT trim(operador) AS n FROM zones) ON upper(n) = upper(trim(operador))
""")
def bridge(spark, sf):
    staged = st.staging(spark, sf, ("stg_zonas",))
    companies = star.dimension(star.zone_company_rows(staged), "dim_empresa")
    zones = star.dimension(star.zone_rows(staged), "dim_zona_concesion")
    links = star.bridge_rows(zones, companies)
    named = links.join(companies, "empresa_key").join(zones, "zona_key")
    return named.select("id_objecto", "nombre_empresa", "fuente_vinculo")


@check("k1_dense_numbers", """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) + 1000
  AS number, l_orderkey, l_linenumber FROM lineitem
""")
def dense(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    rows = st.table(spark, sf, "lineitem").select(*order)
    numbered = star.dense_numbers(rows, order, "number", 1000)
    return numbered.select("number", "l_orderkey", "l_linenumber")


# ---- views --------------------------------------------------------------------------

def _plant_tables(spark, sf):
    staged = st.staging(spark, sf, ("stg_centro", "stg_aresep_medios"))
    dims = _dims(staged, "dim_empresa")
    dims["dim_ubicacion"] = star.dimension(star.location_rows(staged), "dim_ubicacion")
    dims["dim_central_electrica"] = star.dimension(
        star.plant_rows(staged, dims["dim_ubicacion"]), "dim_central_electrica"
    )
    return dims


def _plant_list(spark, sf):
    return views.plant_list(_plant_tables(spark, sf), F.col("operador"))


@check("v1_plant_list", f"""
WITH {st.PLANTS}
SELECT DISTINCT operador AS nombre_empresa, provincia, canton, central_electrica, fuente, operador FROM plants
""")
def plant_list(spark, sf):
    return _plant_list(spark, sf).drop("coordenada_x", "coordenada_y")


INCOME = f"""
WITH {st.PRICES}, {st.DISTRIBUTION}, income AS (
  SELECT p.empresa AS nombre_empresa, p.ano AS anio, p.mes, p.tarifa,
    coalesce(d.bloque, 'SIN BLOQUE ASOCIADO') AS bloque_consumo, d.tipo_tarifa,
    CAST(CAST(d.tarifa_promedio AS DECIMAL(18,6)) AS DOUBLE) AS tarifa_promedio,
    p.ventas AS ventas_por_mes, p.ingreso_con_cvg
  FROM stg_prices p LEFT JOIN (SELECT * REPLACE (CASE WHEN tipo_tarifa = '5-LOW' OR descripcion_tarifa = 'FURNITURE'
    THEN 'OTRA ' || descripcion_tarifa ELSE descripcion_tarifa END AS descripcion_tarifa) FROM stg_dist) d
    ON d.empresa = p.empresa AND d.anho = p.ano AND d.id_mes = p.mes AND d.descripcion_tarifa = p.tarifa
)
"""


def _income(spark, sf):
    staged = dict(st.staging(spark, sf, ("stg_aresep_medios", "stg_distribucion")))
    # Some tariffs get a name of their own, so sales without a block occur; no row is left out.
    own = (F.col("tipo_tarifa") == "5-LOW") | (F.col("descripcion_tarifa") == "FURNITURE")
    name = F.when(own, F.concat(F.lit("OTRA "), "descripcion_tarifa")).otherwise(F.col("descripcion_tarifa"))
    staged["stg_distribucion"] = staged["stg_distribucion"].withColumn("descripcion_tarifa", name)
    tables = _dims(staged, "dim_tiempo", "dim_empresa", "dim_tarifa")
    tables["fact_tarifa_electricidad"] = star.price_facts(staged, tables)
    tables["fact_distribucion_tarifaria"] = star.distribution_facts(staged, tables)
    return views.monthly_income(tables)


@check("v2_monthly_income", f"""
{INCOME}
SELECT nombre_empresa, anio, mes, tarifa, bloque_consumo, tipo_tarifa,
  tarifa_promedio, ventas_por_mes, ingreso_con_cvg FROM income
""")
def monthly_income(spark, sf):
    doubles = ("tarifa_promedio", "ventas_por_mes", "ingreso_con_cvg")
    rows = _income(spark, sf)
    return rows.withColumns({c: F.col(c).cast("double") for c in doubles})


BLOCKS = """
blocks AS (
  SELECT nombre_empresa, tarifa, bloque_consumo, tipo_tarifa, avg(tarifa_promedio) AS tarifa_promedio_avg,
    CAST(sum(CAST(ventas_por_mes AS DECIMAL(18,2))) AS DOUBLE) AS ventas_total,
    CAST(sum(CAST(ingreso_con_cvg AS DECIMAL(18,2))) AS DOUBLE) AS ingreso_total
  FROM income WHERE bloque_consumo <> 'SIN BLOQUE ASOCIADO' AND tarifa_promedio > 0 GROUP BY ALL
)
"""


@check("a25_block_figures", f"""
{INCOME}, {BLOCKS}
SELECT nombre_empresa, tarifa, bloque_consumo, tipo_tarifa,
  round(tarifa_promedio_avg, 2) AS tarifa_promedio_avg, ventas_total, ingreso_total FROM blocks
""")
def block_figures(spark, sf):
    rows = reports.block_figures(_income(spark, sf))
    doubles = ("tarifa_promedio_avg", "ventas_total", "ingreso_total")
    return rounded(rows.withColumns({c: F.col(c).cast("double") for c in doubles}), 2, "tarifa_promedio_avg")


@check("a26_block_means", f"""
{INCOME}, {BLOCKS}
SELECT bloque_consumo, round(avg(tarifa_promedio_avg), 2) AS tarifa_promedio FROM blocks GROUP BY bloque_consumo
""")
def block_means(spark, sf):
    rows = reports.block_means(reports.block_figures(_income(spark, sf)))
    return rounded(rows.withColumn("tarifa_promedio", F.col("tarifa_promedio").cast("double")), 2, "tarifa_promedio")


@check("a23_block_matrix", f"""
{INCOME}, {BLOCKS}
SELECT nombre_empresa, round(coalesce(sum(ventas_total) FILTER (WHERE bloque_consumo = 'F'), 0), 2) AS "F",
  round(coalesce(sum(ventas_total) FILTER (WHERE bloque_consumo = 'O'), 0), 2) AS "O",
  round(coalesce(sum(ventas_total) FILTER (WHERE bloque_consumo = 'P'), 0), 2) AS "P"
FROM blocks GROUP BY nombre_empresa
""")
def block_matrix(spark, sf):
    rows = reports.block_matrix(reports.block_figures(_income(spark, sf)), ["F", "O", "P"])
    return rounded(rows.withColumns({c: F.col(c).cast("double") for c in ("F", "O", "P")}), 2, "F", "O", "P")


@check("v3_plants_per_company", f"""
WITH {st.PLANTS}
SELECT operador AS empresa_canonica, count(DISTINCT central_electrica) AS cantidad_centrales_asociadas,
  string_agg(DISTINCT fuente, ', ' ORDER BY fuente) AS fuentes_electricas_agregadas,
  string_agg(DISTINCT central_electrica, ', ' ORDER BY central_electrica) AS centrales_electricas_agregadas,
  string_agg(DISTINCT operador, ', ' ORDER BY operador) AS operadores_centrales_agregados
FROM plants GROUP BY operador
""")
def plants_per_company(spark, sf):
    return views.plants_per_company(_plant_list(spark, sf))


@check("v3_company_facets", f"""
WITH {st.PLANTS}
SELECT DISTINCT operador AS empresa_canonica, unnest(['fuente', 'central_electrica', 'operador']) AS clase,
  unnest([fuente, central_electrica, operador]) AS valor FROM plants
""")
def company_facets(spark, sf):
    return views.company_facets(_plant_list(spark, sf))


@check("a22_plants_by_province", f"""
WITH {st.PLANTS}
SELECT provincia, count(DISTINCT central_electrica) AS centrales FROM plants GROUP BY provincia
""")
def by_province(spark, sf):
    return reports.plants_by_province(_plant_list(spark, sf))


@check("a23_source_matrix", f"""
WITH {st.PLANTS}
SELECT operador AS nombre_empresa,
  CAST(count(*) FILTER (WHERE fuente = 'EOLICA') AS DOUBLE) AS "EOLICA",
  CAST(count(*) FILTER (WHERE fuente = 'HIDRICA') AS DOUBLE) AS "HIDRICA",
  CAST(count(*) FILTER (WHERE fuente = 'SOLAR') AS DOUBLE) AS "SOLAR",
  CAST(count(*) FILTER (WHERE fuente = 'TERMICA') AS DOUBLE) AS "TERMICA"
FROM plants GROUP BY operador
""")
def source_matrix(spark, sf):
    return reports.source_matrix(_plant_list(spark, sf), ["EOLICA", "HIDRICA", "SOLAR", "TERMICA"])


@check("j8_sales_and_plants", f"""
WITH {st.WIDE}, {st.PLANTS}, s AS (SELECT empresa, sum(ventas) AS v FROM base GROUP BY empresa),
p AS (SELECT operador, count(DISTINCT central_electrica) AS n FROM plants GROUP BY operador)
SELECT empresa AS empresa_canonica, round(v, 2) AS ventas, n AS cantidad_centrales_asociadas
FROM s JOIN p ON empresa = operador
""")
def sales_and_plants(spark, sf):
    per_company = views.plants_per_company(_plant_list(spark, sf))
    return rounded(reports.sales_and_plants(base(spark, sf), per_company), 2, "ventas")
