"""Sources, sinks, recipes and geography."""

from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.checks import standins as st
from energy_mart.checks.projections import LON_LAT
from energy_mart.checks.registry import check
from energy_mart.operators import project
from energy_mart.plans import geo, jobs, recipes
from energy_mart.session import scratch_path
from energy_mart.sources import climate, files, tables


@check("s1_multi_file_csv", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey FROM orders
""")
def multi_file(spark, sf):
    """Three layouts: other column order, and one file set without a column."""
    orders = st.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey", "o_orderstatus")
    root = scratch_path(spark, "csv")
    layouts = {
        "F": ["o_orderkey", "o_orderpriority", "o_custkey"],
        "O": ["o_custkey", "o_orderkey", "o_orderpriority"],
        "P": ["o_orderpriority", "o_orderkey"],
    }
    for status, columns in layouts.items():
        files.write_csv(orders.filter(F.col("o_orderstatus") == status).select(*columns), f"{root}/{status}")
    return files.read_csv_files(spark, f"{root}/*/*.csv")


@check("s2_csv_options", """
SELECT CAST(c_custkey AS VARCHAR) AS clave, 'año ' || c_name AS nombre FROM customer
""")
def csv_options(spark, sf):
    path = scratch_path(spark, "latin")
    rows = st.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("clave"), F.concat(F.lit("año "), "c_name").alias("nombre")
    )
    rows.write.options(header="true", sep=";", encoding="ISO-8859-1").csv(path)
    return files.read_csv(spark, path, sep=";", encoding="ISO-8859-1")


@check("s3_climate_csv", f"""
WITH {st.CLIMATE} SELECT empresa, ano, mes, t2m, ws10m, allsky_sfc_lw_dwn FROM stg_climate
""")
def climate_csv(spark, sf):
    path = scratch_path(spark, "climate")
    files.write_csv(st.climate_raw(spark, sf), path)
    rows = project.to_model(climate.read_climate(spark, path), schemas.CLIMATE)
    return rows.select("empresa", "ano", "mes", "t2m", "ws10m", "allsky_sfc_lw_dwn")


@check("s4_company_points", f"""
WITH {st.PLANTS}
SELECT DISTINCT operador AS empresa, y AS lat, x AS lon FROM plants
WHERE CAST(replace(operador, 'NATION_', '') AS INTEGER) < 20
""")
def company_points(spark, sf):
    path = scratch_path(spark, "plants")
    files.write_csv(st.plants_raw(spark, sf), path)
    return files.company_points(files.read_plants(spark, path), st.CODES)


PAYLOAD_VARIABLES = ("T2M", "WS10M")


def supplier_payloads(spark, sf):
    """One JSON payload per supplier: two variables by month, a sentinel and a yearly key."""
    lines, supplier, nation = (st.table(spark, sf, t) for t in ("lineitem", "supplier", "nation"))
    monthly = lines.groupBy(
        "l_suppkey", F.date_format("l_shipdate", "yyyyMM").alias("ym")
    ).agg(st.money_sum("l_quantity").cast("double").alias("q"), F.max("l_discount").alias("d"))
    keyed = monthly.groupBy("l_suppkey").agg(
        F.map_from_entries(F.collect_list(F.struct("ym", "q"))).alias("t2m"),
        F.map_from_entries(
            F.collect_list(
                F.struct(
                    "ym",
                    F.when(F.substring("ym", 5, 2) == "07", F.lit(-999.0)).otherwise(F.col("d")).alias("v"),
                )
            )
        ).alias("ws10m"),
    )
    yearly = F.create_map(F.lit("199713"), F.lit(1.0))
    parameter = F.create_map(
        F.lit("T2M"), F.map_concat("t2m", yearly), F.lit("WS10M"), F.map_concat("ws10m", yearly)
    )
    payload = F.to_json(F.struct(F.struct(parameter.alias("parameter")).alias("properties")))
    return (
        keyed.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("l_suppkey", F.col("n_name").alias("empresa"), payload.alias("payload"))
    )


@check("s5_climate_payload", """
WITH m AS (
  SELECT n_name, l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q, max(l_discount) AS d
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL
)
SELECT n_name AS empresa, y AS ano, m AS mes, round(avg(q), 6) AS t2m,
  round(avg(CASE WHEN m <> 7 THEN d END), 6) AS ws10m
FROM m GROUP BY n_name, y, m
""")
def climate_payload(spark, sf):
    rows = climate.monthly_climate(supplier_payloads(spark, sf), variables=PAYLOAD_VARIABLES)
    return project.to_model(rows, schemas.CLIMATE).select(
        "empresa", "ano", "mes", F.round("t2m", 6).alias("t2m"), F.round("ws10m", 6).alias("ws10m")
    )


@check("s5_json_props", """
SELECT event_type, CAST(props->>'$.k' AS INTEGER) AS k, count(*) AS n FROM events GROUP BY ALL
""")
def json_props(spark, sf):
    k = F.from_json("props", "map<string,int>")["k"].alias("k")
    return st.table(spark, sf, "events").groupBy("event_type", k).agg(F.count(F.lit(1)).alias("n"))


@check("s6_catalog_refresh", """
SELECT doc_id AS id, md5(text) AS texto, lang || ', "' || source || '"' AS tags FROM
  (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents)
""")
def catalog(spark, sf):
    """Texts with commas, quotes and newlines through the dictionary reader, whole."""
    folder, root = scratch_path(spark, "docs"), scratch_path(spark, "catalogs")
    rows = st.table(spark, sf, "documents").select(
        F.col("doc_id").alias("ID"),
        F.col("text").alias("Description"),
        F.concat("lang", F.lit(', "'), "source", F.lit('"')).alias("Tags"),
    )
    files.write_csv(rows, f"{folder}/dictionary.csv")
    tables.refresh_catalogs(
        spark, folder, root, {"dictionary.csv": ("catalogo_textos", ("ID", "Tags", "Description"))}
    )
    loaded = tables.catalog(spark, root, "catalogo_textos")
    return loaded.select("id", F.md5("description").alias("texto"), "tags")


@check("s7_s8_table_and_view", """
SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'all', count(*) FROM orders
""")
def table_and_view(spark, sf):
    st.table(spark, sf, "orders").createOrReplaceTempView("energy_orders")
    tables.statement(
        spark,
        "CREATE OR REPLACE TEMPORARY VIEW energy_order_status AS "
        "SELECT o_orderstatus, count(*) AS n FROM energy_orders GROUP BY o_orderstatus",
    )
    whole = tables.table(spark, "energy_orders").agg(F.count(F.lit(1)).alias("n"))
    return tables.view(spark, "energy_order_status").unionByName(
        whole.select(F.lit("all").alias("o_orderstatus"), "n")
    )


@check("s9_parametrised_query", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 200000
""")
def parametrised(spark, sf):
    st.table(spark, sf, "orders").createOrReplaceTempView("energy_orders")
    return tables.query(
        spark,
        "SELECT o_orderkey, o_totalprice FROM energy_orders WHERE o_orderpriority = ? AND o_totalprice > ?",
        ["1-URGENT", 200000],
    )


@check("s11_csv_sink", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part
""")
def csv_sink(spark, sf):
    path = scratch_path(spark, "sink")
    files.write_csv(st.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), path)
    return files.read_csv(spark, path)


@check("s12_s13_staging", f"""
WITH {st.PLANTS} SELECT id_objecto, operador, central_electrica, codigo_dta FROM plants
UNION ALL SELECT id_objecto, operador, central_electrica, codigo_dta FROM plants
""")
def staging(spark, sf):
    """Appended, emptied, then appended twice: bag semantics."""
    area = tables.Staging(spark, scratch_path(spark, "staging"))
    rows = st.staging(spark, sf, ("stg_centro",))["stg_centro"]
    area.append("stg_centro", rows)
    area.clear()
    area.append("stg_centro", rows)
    area.append("stg_centro", rows)
    return area.read("stg_centro").select("id_objecto", "operador", "central_electrica", "codigo_dta")


@check("s14_zone_csv", f"""
WITH {st.ZONES}
SELECT id_objecto, trim(operador) AS operador, descripcion, tipo_geometria FROM zones
""")
def zone_csv(spark, sf):
    path = scratch_path(spark, "zones")
    files.write_csv(st.zones_raw(spark, sf), path)
    rows = project.to_model(recipes.prepare_zones(files.read_zones(spark, path)), schemas.ZONES)
    return rows.select("id_objecto", F.trim("operador").alias("operador"), "descripcion", "tipo_geometria")


# ---- recipes ------------------------------------------------------------------------

@check("r10a_plants", f"""
WITH {st.PLANTS}, {LON_LAT}
SELECT id_objecto, central_electrica, lon AS coordenada_x, lat AS coordenada_y FROM lonlat
""")
def recipe_plants(spark, sf):
    rows = project.to_model(recipes.prepare_plants(st.plants_raw(spark, sf)), schemas.PLANTS)
    return rows.select(
        "id_objecto", "central_electrica", F.round("coordenada_x", 7).alias("coordenada_x"),
        F.round("coordenada_y", 7).alias("coordenada_y"),
    )


@check("r10c_distribution", f"""
WITH {st.PRICES}, {st.DISTRIBUTION}
SELECT id_mes, upper(month_name[1]) || lower(month_name[2:]) AS mes, anho, empresa, tipo_tarifa,
  descripcion_tarifa, bloque, round(tarifa_promedio, 3) AS tarifa_promedio
FROM stg_dist JOIN month_names ON m = id_mes
""")
def recipe_distribution(spark, sf):
    kept = recipes.prepare_distribution(st.distribution_raw(spark, sf))
    rows = project.to_model(kept, schemas.DISTRIBUTION)
    names = [f.name for f in schemas.DISTRIBUTION if f.source in kept.columns]
    return rows.select(*names).withColumn("tarifa_promedio", F.round("tarifa_promedio", 3))


@check("r10d_fuels", f"""
WITH {st.FUELS}
SELECT numero_expediente, fecha_publicacion, producto, tipo_cambio, canon, margen_distribuidor, rige,
  precio_final FROM stg_fuels
""")
def recipe_fuels(spark, sf):
    rows = project.to_model(recipes.prepare_fuels(st.fuels_raw(spark, sf)), schemas.FUELS)
    return rows.select(
        "numero_expediente", "fecha_publicacion", "producto", "tipo_cambio", "canon",
        "margen_distribuidor", "rige", "precio_final",
    )


# ---- geography ----------------------------------------------------------------------

VERTICES = f"""
WITH {st.ZONES}, parts AS (
  SELECT *, unnest(CASE tipo_geometria WHEN 'MULTIPOLYGON' THEN [0, 1] ELSE [0] END) AS part FROM zones
),
v AS (
  SELECT *, unnest(CASE tipo_geometria WHEN 'POINT' THEN [[0, 0, 0]]
    ELSE [[0, 0, 0], [1, 1000, 0], [2, 1000, 1000], [3, 0, 0]] END) AS o FROM parts
),
vertices AS (
  SELECT id_objecto, CAST(part AS INTEGER) AS part, CAST(0 AS INTEGER) AS ring,
    CAST(o[1] AS INTEGER) AS vertex, CAST(x + o[2] AS DOUBLE) AS x, CAST(y + o[3] AS DOUBLE) AS y FROM v
)
"""


def staged_zones(spark, sf):
    return project.to_model(recipes.prepare_zones(st.zones_raw(spark, sf)), schemas.ZONES)


@check("g2_zone_vertices", f"{VERTICES} SELECT * FROM vertices")
def vertices(spark, sf):
    return geo.zone_vertices(staged_zones(spark, sf)).drop("lon", "lat")


@check("g2_zone_boxes", f"""
{VERTICES}, {LON_LAT.replace("FROM plants", "FROM vertices")}
SELECT id_objecto, count(*) AS vertices, CAST(max(part) + 1 AS INTEGER) AS parts, min(lon) AS lon_min,
  max(lon) AS lon_max, min(lat) AS lat_min, max(lat) AS lat_max FROM lonlat GROUP BY id_objecto
""")
def boxes(spark, sf):
    rows = geo.zone_boxes(staged_zones(spark, sf))
    return rows.withColumns({c: F.round(c, 7) for c in ("lon_min", "lon_max", "lat_min", "lat_max")})


@check("g3_zone_records", f"""
WITH {st.ZONES}
SELECT id_objecto, operador, 'Zona no definida' AS zona, descripcion, round(area, 2) AS area,
  CAST(5367 AS INTEGER) AS srid FROM zones
""")
def records(spark, sf):
    return geo.zone_records(staged_zones(spark, sf))


@check("r10b_zones", f"""
WITH {st.ZONES}
SELECT id_objecto, operador, descripcion, tipo_geometria FROM zones
""")
def recipe_zones(spark, sf):
    return staged_zones(spark, sf).select("id_objecto", "operador", "descripcion", "tipo_geometria")


# ---- whole runs ---------------------------------------------------------------------

@check("e2_wide_dataset", f"""
WITH {st.PRICES}, {st.CLIMATE}
SELECT p.empresa, p.tarifa, p.sistema, p.ano, p.mes, p.ventas, p.ingreso_con_cvg, c.cloud_amt, c.t2m_max
FROM stg_prices p LEFT JOIN stg_climate c USING (empresa, ano, mes)
""")
def wide_dataset(spark, sf):
    """Landed price and climate files to the derived wide file, read back."""
    root = scratch_path(spark, "wide")
    files.write_csv(st.prices_raw(spark, sf), f"{root}/prices")
    files.write_csv(st.climate_raw(spark, sf), f"{root}/climate")
    jobs.wide_dataset(spark, f"{root}/prices/*.csv", f"{root}/climate", f"{root}/out")
    stored = files.read_csv(spark, f"{root}/out/{jobs.WIDE_FILE}")
    return recipes.report_table(stored).select(
        "empresa", "tarifa", "sistema", "ano", "mes", "ventas", "ingreso_con_cvg", "cloud_amt", "t2m_max"
    )


@check("w0_stage_with_rejects", f"""
WITH {st.ZONES}, z AS (
  SELECT id_objecto, descripcion || CASE WHEN id_objecto % 10 = 0 THEN repeat('x', 200) ELSE '' END AS d
  FROM zones
)
SELECT id_objecto, length(d) > 200 AS rejected FROM z
""")
def stage_with_rejects(spark, sf):
    """Rows too wide for staging end in the reject folder, the others in the table."""
    long = F.when(F.col("id_Objecto") % 10 == 0, "x" * 200).otherwise("")
    raw = st.zones_raw(spark, sf).withColumn("descripcion", F.concat("descripcion", long))
    area = tables.Staging(spark, scratch_path(spark, "staging"))
    jobs.stage(area, "stg_zonas", recipes.prepare_zones(raw))
    kept = area.read("stg_zonas").select("id_objecto", F.lit(False).alias("rejected"))
    rejects = area.rejects("stg_zonas")
    return kept.unionByName(rejects.select(F.col("id_Objecto").alias("id_objecto"), F.lit(True).alias("rejected")))


@check("w0b_zone_merge", f"""
WITH {st.ZONES}
SELECT id_objecto, CASE WHEN id_objecto % 4 = 0 THEN 'NUEVO' ELSE operador END AS operador,
  CAST(5367 AS INTEGER) AS srid FROM zones
""")
def zone_merge(spark, sf):
    """Staged zones, then a batch that updates every fourth one and adds the even ones left out."""
    zones = staged_zones(spark, sf)
    area = tables.Staging(spark, scratch_path(spark, "staging"))
    area.clear(["stg_zonas"])
    area.append("stg_zonas", zones.filter("id_objecto % 2 = 1 or id_objecto % 4 = 0"))
    renamed = F.when(F.col("id_objecto") % 4 == 0, "NUEVO").otherwise(F.col("operador"))
    batch = zones.filter("id_objecto % 2 = 0").withColumn("operador", renamed)
    area.merge("stg_zonas", batch, ["id_objecto"])
    return area.read("stg_zonas").select("id_objecto", "operador", "srid")
