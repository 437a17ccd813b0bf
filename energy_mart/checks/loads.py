"""Writers that meet, corrections by year, small folders, broken constraints and rejects."""

from functools import reduce

from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.checks import inputs, standins as st
from energy_mart.checks.registry import check
from energy_mart.operators import wide
from energy_mart.plans import geo, star
from energy_mart.session import literal_rows, scratch_path, spread
from energy_mart.sources import climate, files, tables
from energy_mart.sources.versions import State

PRICES = "fact_tarifa_electricidad"
PRICES_ONLY = ("stg_aresep_medios",)


def _named(target):
    """Price facts by date, company and tariff name."""
    out = target.read(PRICES).join(target.read("dim_tiempo").select("tiempo_key", "fecha"), "tiempo_key")
    out = out.join(target.read("dim_empresa"), "empresa_key")
    return out.join(target.read("dim_tarifa").select("tarifa_key", "nombre_tarifa"), "tarifa_key").select(
        "fecha", "nombre_empresa", F.col("nombre_tarifa").alias("tarifa"), F.col("ventas").cast("double").alias("ventas")
    )


@check("k4_two_loads", f"""
WITH {st.PRICES}
SELECT make_date(ano, mes, 1) AS fecha, empresa AS nombre_empresa, tarifa, ventas FROM stg_prices
""")
def two_loads(spark, sf):
    """A load that another one overtakes just before it publishes is made again; both loads' rows are there."""
    staged, root = dict(st.staging(spark, sf, PRICES_ONLY)), scratch_path(spark, "star")
    rows, name = staged["stg_aresep_medios"], PRICES_ONLY[0]
    late, quick = star.Star(spark, root), star.Star(spark, root)
    check_late, overtaken = late._check, []

    def overtake():
        if not overtaken:
            overtaken.append(quick.load({**staged, name: rows.filter("mes % 2 = 0")}))
        check_late()

    late._check = overtake
    late.load({**staged, name: rows.filter("mes % 2 = 1 OR ano = 1996")})
    return _named(star.Star(spark, root))


@check("w9_update_year", f"""
WITH {st.PRICES}
SELECT ano AS anio, count(*) AS filas, round(sum(ventas) + CASE WHEN ano = 1995 THEN count(ventas) ELSE 0 END, 2) AS ventas,
  ano = 1995 AS escrito FROM stg_prices GROUP BY ano
""")
def update_year(spark, sf):
    """A correction of 1995 writes that year's folder anew and leaves those of the others."""
    staged, target = dict(st.staging(spark, sf, PRICES_ONLY)), star.Star(spark, scratch_path(spark, "star"))
    target.load(staged)
    before = set(target.versions.current()[PRICES].folders)
    changed = staged["stg_aresep_medios"].filter("ano = 1995").withColumn("ventas", F.col("ventas") + 1)
    target.load({**staged, "stg_aresep_medios": changed}, update_facts=True)
    now = target.versions.refresh()[PRICES].folders
    written = [int(f.rsplit("=", 1)[1]) for f in now if f not in before]
    dates = target.read("dim_tiempo").select("tiempo_key", "anio")
    sums = target.read(PRICES).join(dates, "tiempo_key").groupBy("anio").agg(
        F.count(F.lit(1)).alias("filas"), F.round(F.sum("ventas").cast("double"), 2).alias("ventas")
    )
    return sums.withColumn("escrito", F.col("anio").isin(written))


@check("w_compacted_reads", f"""
WITH {st.PRICES}
SELECT mes, count(*) AS filas, CAST(1 AS BIGINT) AS carpetas, CAST(20 AS BIGINT) AS juntadas FROM stg_prices GROUP BY mes
""")
def compacted_reads(spark, sf):
    """Twenty appends, then one folder; versions that nothing reads any more go with their folders."""
    rows = st.staging(spark, sf, PRICES_ONLY)["stg_aresep_medios"]
    area, name = tables.Staging(spark, scratch_path(spark, "stg")), "stg_aresep_medios"
    for k in range(20):
        area.append(name, rows.filter(F.pmod(F.col("mes") + 12 * F.col("ano"), F.lit(20)) == k))
    merged = area.compact(name)
    area.versions.expire(keep=1, hours=0)
    folders = area.versions.refresh()[name].folders
    stored = area.read(name).groupBy("mes").agg(F.count(F.lit(1)).alias("filas"))
    return stored.select(
        "mes", "filas", F.lit(len(folders)).cast("long").alias("carpetas"), F.lit(merged).cast("long").alias("juntadas")
    )


@check("a29_losses", f"""
WITH {st.PRICES}, marked AS (
  SELECT mes % 5 = 0 AS undated, ano % 3 = 0 AS unnamed, mes % 4 = 0 AS untaxed FROM stg_prices
)
SELECT 'fact_tarifa_electricidad' AS objeto, 'dim_tiempo' AS busqueda, count(*) AS filas, count(*) FILTER (undated) AS perdidas FROM marked
UNION ALL SELECT 'fact_tarifa_electricidad', 'dim_empresa', count(*), count(*) FILTER (unnamed) FROM marked WHERE NOT undated
UNION ALL SELECT 'fact_tarifa_electricidad', 'dim_tarifa', count(*), count(*) FILTER (untaxed) FROM marked WHERE NOT undated AND NOT unnamed
UNION ALL SELECT 'stg_aresep_medios', 'columna Trimestre', NULL, NULL
""")
def losses(spark, sf):
    """What each lookup of a load dropped, beside the columns that preparation left out."""
    staged, target = dict(st.staging(spark, sf, PRICES_ONLY)), star.Star(spark, scratch_path(spark, "star"))
    rows = staged["stg_aresep_medios"]
    holes = {
        "mes": F.when(F.col("mes") % 5 != 0, F.col("mes")),
        "empresa": F.when(F.col("ano") % 3 != 0, F.col("empresa")),
        "tarifa": F.when(F.col("mes") % 4 != 0, F.col("tarifa")),
    }
    target.load({**staged, "stg_aresep_medios": rows.withColumns(holes)}, dropped=[("stg_aresep_medios", "Trimestre")])
    return target.losses().filter(F.col("objeto").isin("stg_aresep_medios", PRICES))


@check("q11_blocked_load", f"""
WITH {st.PRICES}
SELECT 'dim_empresa' AS tabla, 'unique nombre_empresa' AS regla, count(DISTINCT empresa) AS filas, CAST(0 AS BIGINT) AS publicadas
FROM stg_prices
""")
def blocked_load(spark, sf):
    """Companies stored twice, by another hand: the next load that writes companies publishes nothing."""
    staged, target = dict(st.staging(spark, sf, PRICES_ONLY)), star.Star(spark, scratch_path(spark, "star"))
    target.load(staged)
    state = target.versions.current()["dim_empresa"]
    again, top = target.versions.fresh_folder("dim_empresa"), state.top_key
    target.read("dim_empresa").withColumn("empresa_key", F.col("empresa_key") + F.lit(top)).write.parquet(again)
    target.versions.publish({"dim_empresa": State((*state.folders, again), 2 * top)})
    before, name = target.versions.number(), "stg_aresep_medios"
    try:
        target.load({**staged, name: staged[name].withColumn("empresa", F.concat(F.lit("NUEVA "), "empresa"))})
    except star.BrokenConstraint as stopped:
        broken = [(*row, target.versions.number() - before) for row in stopped.broken]
    else:
        raise AssertionError("a table with repeated companies must stop the load")
    return literal_rows(spark, broken, "tabla string, regla string, filas bigint, publicadas bigint")


@check("k5_versioned_catalogs", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS tags, p_brand || ',' || chr(10) || '"' || p_type || '"' AS description, 'antes' AS leido FROM part
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'nuevo ' || p_type, p_brand || ',' || chr(10) || '"' || p_type || '"', 'despues' FROM part
""")
def versioned_catalogs(spark, sf):
    """A frame opened before a refresh still reads the old dictionary; the next one reads the new."""
    folder, root = scratch_path(spark, "docs"), scratch_path(spark, "catalogs")
    wanted = {"partes.csv": ("catalogo_partes", ("ID", "Tags", "Description"))}
    rows = st.table(spark, sf, "part").select(
        F.col("p_partkey").alias("ID"), F.col("p_type").alias("Tags"),
        F.concat("p_brand", F.lit(',\n"'), "p_type", F.lit('"')).alias("Description"),
    )
    read = []
    for when, tags in (("antes", F.col("Tags")), ("despues", F.concat(F.lit("nuevo "), "Tags"))):
        files.write_csv(rows.withColumn("Tags", tags), f"{folder}/partes.csv")
        tables.refresh_catalogs(spark, folder, root, wanted)
        read.append(tables.catalog(spark, root, "catalogo_partes").withColumn("leido", F.lit(when)))
    return reduce(lambda a, b: a.unionByName(b), read)


SPOILT = """
CASE CAST(l_suppkey % 6 AS INTEGER) WHEN 1 THEN 'not JSON' WHEN 2 THEN 'a value that is not a number' WHEN 3 THEN 'no payload'
  WHEN 4 THEN 'no series of variables' WHEN 5 THEN 'a key that is not a month' ELSE 'accepted' END
"""


@check("s5_payload_rejects", f"""
WITH s AS (SELECT DISTINCT l_suppkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT {SPOILT} AS motivo, count(*) AS cargas FROM s GROUP BY ALL
""")
def payload_rejects(spark, sf):
    """Payloads cut off, with a text among the values, missing, of another shape, or with strange keys."""
    given = inputs.supplier_payloads(spark, sf)
    kind, p = F.col("l_suppkey") % 6, F.col("payload")
    spoilt = (
        F.when(kind == 1, F.substring(p, F.lit(1), F.length(p) - 7))
        .when(kind == 2, F.regexp_replace(p, r"\{\"([0-9]{6})\":[^,}]+", r'{"$1":"alto"'))
        .when(kind == 4, F.replace(p, F.lit("parameter"), F.lit("parametro")))
        .when(kind == 5, F.regexp_replace(p, r"\"199713\"", '"anual"'))
        .when(kind == 0, p)
    )
    accepted, rejected = climate.split_payloads(given.withColumn("payload", spoilt))
    reasons = accepted.select(F.lit("accepted").alias("motivo")).unionAll(rejected.select(F.explode("reject_reasons")))
    return reasons.groupBy("motivo").agg(F.count(F.lit(1)).alias("cargas"))


@check("g2_zone_rejects", f"""
WITH {st.ZONES}
SELECT id_objecto, CASE WHEN id_objecto % 4 = 1 THEN 'not a geometry' WHEN id_objecto % 4 = 3 THEN 'not a geometry'
  WHEN tipo_geometria = 'POINT' THEN 'not a geometry' ELSE 'a ring that is not closed' END AS motivo
FROM zones WHERE id_objecto % 4 <> 0
""")
def zone_rejects(spark, sf):
    """Every fourth zone whole; the others lose a bracket, get a point too many, or letters in their numbers."""
    zones, kind, w = inputs.staged_zones(spark, sf), F.col("id_objecto") % 4, F.col("coordenadas")
    spoilt = (
        F.when(kind == 1, F.regexp_replace(w, r"\)\s*$", ""))
        .when(kind == 2, F.regexp_replace(w, r"(\)+)\s*$", ", 1 1$1"))
        .when(kind == 3, F.regexp_replace(w, "[0-9]", "o"))
        .otherwise(w)
    )
    broken = zones.withColumn("coordenadas", spoilt)
    _, rejected = geo.split_zones(broken)
    kept = geo.zone_vertices(broken).select("id_objecto").distinct()
    # A zone that is rejected has no vertex at all.
    return rejected.join(kept, "id_objecto", "left_anti").select("id_objecto", F.element_at("reject_reasons", 1).alias("motivo"))


COLUMNS = 200
_CELL = "CASE WHEN (p_partkey + {i}) % 13 <> 0 THEN p_retailprice * ({i} % 7 + 1) + p_size * ({i} % 11) + (p_partkey * ({i} + 3)) % 101 END"


@check("a17_wide_correlations", f"""
WITH cells AS (
  SELECT p_partkey AS k, i, {_CELL.format(i="i")} AS v FROM part, range({COLUMNS}) AS r(i)
)
SELECT 'c' || x.i AS a, 'c' || y.i AS b, count(*) AS n, round(corr(x.v, y.v), 6) AS corr
FROM cells x JOIN cells y ON x.k = y.k AND x.i < y.i WHERE x.v IS NOT NULL AND y.v IS NOT NULL GROUP BY x.i, y.i
""")
def wide_correlations(spark, sf):
    """All pairs of 200 columns, each over the rows that have both."""
    # Three columns make 200 cells a row, much work for a file that is one task to read.
    part = spread(st.table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size"))
    cells = part.selectExpr(*[f"{_CELL.format(i=i)} AS c{i}" for i in range(COLUMNS)])
    return wide.wide_correlations(cells).withColumn("corr", F.round("corr", 6))


@check("s14_split_records", """
SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS texto, lang || ', "' || source || '"' AS notas, true AS en_rangos FROM documents
""")
def split_records(spark, sf):
    """Texts with commas, quotes and line breaks; each file is read in many byte ranges."""
    folder, size = scratch_path(spark, "split"), "spark.sql.files.maxPartitionBytes"
    rows = st.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "text", F.concat("lang", F.lit(', "'), "source", F.lit('"')).alias("notas")
    )
    files.write_csv(rows, folder)
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        ranges = spark.read.text(folder).rdd.getNumPartitions()
        read = files.read_csv_split(spark, folder)
    finally:
        spark.conf.set(size, before)
    return read.select("id", F.md5("text").alias("texto"), "notas", F.lit(ranges > 4).alias("en_rangos"))


@check("s1_many_layouts", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS "clase, ""pedido"" de" FROM orders
""")
def many_layouts(spark, sf):
    """Files of three layouts by year, with a comma and quotes in a header; headers are read by one job."""
    orders = st.table(spark, sf, "orders").withColumn('clase, "pedido" de', F.col("o_orderpriority")).withColumn("y", F.year("o_orderdate"))
    root = scratch_path(spark, "layouts")
    layouts = {
        "F": ['clase, "pedido" de', "o_custkey", "o_orderkey"],
        "O": ["o_custkey", "o_orderkey"],
        "P": ["o_orderkey", 'clase, "pedido" de'],
    }
    for status, columns in layouts.items():
        chosen = orders.filter(F.col("o_orderstatus") == status).select("y", *[F.col(f"`{c}`") for c in columns])
        chosen.write.partitionBy("y").options(header="true", escape='"').csv(f"{root}/{status}")
    read = files.read_csv_files(spark, f"{root}/*/*/*.csv")
    return read.select("o_orderkey", "o_custkey", '`clase, "pedido" de`')
