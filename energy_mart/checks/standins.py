"""Domain frames derived from the driver's tables, and the same as SQL for the other engine.

Money sums go through decimals, so both engines agree to the last digit.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.functions import text
from energy_mart.operators.project import to_model
from energy_mart.plans import recipes
from energy_mart.session import empty_frame, materialise, shared_dir
from energy_mart.sources.climate import clean_climate_keys

MONEY = "decimal(18,2)"
UPPER_MONTHS = {n: name for name, n in text.MONTHS.items()}
CODES = {f"NATION_{i}": f"NATION_{i}" for i in range(20)}
SOURCES = {0: "HIDRICA", 1: "EOLICA", 2: "SOLAR", 3: "TERMICA"}
LABELS = {
    "AUTOMOBILE": "Auto", "BUILDING": "Building", "FURNITURE": "Furniture", "MACHINERY": "Machinery",
}
PERIODS = {"Antes (1995-1996)": (1995, 1996), "Medio (1997-1998)": (1997, 1998)}
LAST_PERIOD = "Despues (1999-)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money_sum(c: str) -> Column:
    return F.sum(F.col(c).cast(MONEY)).cast("decimal(28,2)")


# ---- wide table: one row per order --------------------------------------------------

def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return joined.select(
        key.alias("row_id"),
        F.col("n_name").alias("empresa"),
        F.col("c_mktsegment").alias("tarifa"),
        F.col("o_orderstatus").alias("sistema"),
        F.year("o_orderdate").alias("ano"),
        F.month("o_orderdate").alias("mes"),
        F.when(F.col("o_orderstatus") != "P", F.col("c_nationkey").cast("double")).alias("abonados"),
        (F.col("o_totalprice") / F.lit(1.13)).alias("ventas"),
        F.col("o_totalprice").alias("ingreso_con_cvg"),
        (F.col("o_totalprice") / (cust % 97 + F.lit(1.3))).alias("precio_medio_con_cvg"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(-999.0))
        .otherwise(F.col("c_acctbal") / 397)
        .alias("t2m"),
        ((key % 31) / F.lit(3.1)).alias("ws10m"),
        (cust % 41 + 60).cast("double").alias("rh2m"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(-999.0))
        .otherwise((key * 7 % 101) / F.lit(9.7))
        .alias("prectotcorr"),
        (F.col("c_acctbal") / 397 + key % 7).alias("t2m_max"),
    )


WIDE = """
wide AS (
  SELECT o_orderkey AS row_id, n_name AS empresa, c_mktsegment AS tarifa,
    o_orderstatus AS sistema,
    CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(c_nationkey AS DOUBLE) END AS abonados,
    o_totalprice / 1.13e0 AS ventas, o_totalprice AS ingreso_con_cvg,
    o_totalprice / (CAST(o_custkey % 97 AS DOUBLE) + 1.3e0) AS precio_medio_con_cvg,
    CASE WHEN o_orderpriority = '5-LOW' THEN -999e0 ELSE c_acctbal / 397e0 END AS t2m_raw,
    CAST(o_orderkey % 31 AS DOUBLE) / 3.1e0 AS ws10m,
    CAST(o_custkey % 41 + 60 AS DOUBLE) AS rh2m,
    CASE WHEN o_orderpriority = '1-URGENT' THEN -999e0
         ELSE CAST(o_orderkey * 7 % 101 AS DOUBLE) / 9.7e0 END AS prectotcorr_raw,
    c_acctbal / 397e0 + CAST(o_orderkey % 7 AS DOUBLE) AS t2m_max
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
base AS (
  SELECT *, nullif(t2m_raw, -999e0) AS t2m, nullif(prectotcorr_raw, -999e0) AS prectotcorr,
    CASE WHEN ano IN (1995, 1996) THEN 'Antes (1995-1996)'
         WHEN ano IN (1997, 1998) THEN 'Medio (1997-1998)' ELSE 'Despues (1999-)' END AS periodo,
    CASE WHEN mes IN (12, 1, 2, 3, 4) THEN 'Verano (Dic-Abr)' ELSE 'Lluvioso (May-Nov)' END
      AS estacion,
    CASE tarifa WHEN 'AUTOMOBILE' THEN 'Auto' WHEN 'BUILDING' THEN 'Building'
      WHEN 'FURNITURE' THEN 'Furniture' WHEN 'MACHINERY' THEN 'Machinery' END AS tarifa_label
  FROM wide
)
"""


# ---- prices as landed: text columns, dirty keys, total rows -------------------------

def _month_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    )


def prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = _month_orders(spark, sf_dir).groupBy(
        "n_name", "c_mktsegment", "o_orderstatus", "y", "m"
    ).agg(money_sum("o_totalprice").alias("s"), F.count(F.lit(1)).alias("n"))
    month = text.lookup(F.col("m"), UPPER_MONTHS)
    none = F.lit(None).cast("string")
    companies = grouped.select(
        F.when(F.col("m") % 2 == 0, F.concat(F.lit(" "), F.lower(month))).otherwise(month).alias("Mes"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("m") == 2), "s/d")
        .otherwise(F.col("y").cast("string"))
        .alias("Año"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("Empresa"),
        F.col("c_mktsegment").alias("Tarifa"),
        F.when(F.col("o_orderstatus") != "P", F.col("n").cast("string")).alias("Abonados"),
        F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("m") == 6), "n/d")
        .otherwise(F.col("s").cast("string"))
        .alias("Ventas"),
        F.col("s").cast("string").alias("Ingreso con CVG"),
        F.col("n").cast("string").alias("Precio Medio con CVG"),
        F.concat(F.lit("T"), F.ceil(F.col("m") / 3)).alias("Trimestre"),
        F.col("o_orderstatus").alias("Sistema"),
        none.alias("Trimestral"),
    )
    totals = (
        grouped.groupBy("y", "m")
        .agg(F.sum("s").cast("decimal(28,2)").alias("s"))
        .select(
            F.when(F.col("m") % 2 == 0, F.concat(F.lit(" "), F.lower(month))).otherwise(month).alias("Mes"),
            F.col("y").cast("string").alias("Año"),
            F.lit("Total Nacional ").alias("Empresa"),
            F.lit("TODAS").alias("Tarifa"),
            none.alias("Abonados"),
            F.col("s").cast("string").alias("Ventas"),
            # December's total is published without an amount: a month with one side only.
            F.when(F.col("m") != 12, (F.col("s") + F.col("m") * 1100).cast("decimal(28,2)").cast("string")).alias("Ingreso con CVG"),
            none.alias("Precio Medio con CVG"),
            F.concat(F.lit("T"), F.ceil(F.col("m") / 3)).alias("Trimestre"),
            none.alias("Sistema"),
            none.alias("Trimestral"),
        )
    )
    return companies.unionByName(totals)


PRICES = """
month_names(m, month_name) AS (VALUES (1, 'ENERO'), (2, 'FEBRERO'), (3, 'MARZO'), (4, 'ABRIL'),
  (5, 'MAYO'), (6, 'JUNIO'), (7, 'JULIO'), (8, 'AGOSTO'), (9, 'SEPTIEMBRE'), (10, 'OCTUBRE'),
  (11, 'NOVIEMBRE'), (12, 'DICIEMBRE')),
month_orders AS (
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
price_groups AS (
  SELECT n_name, c_mktsegment, o_orderstatus, y, m,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS s, count(*) AS n
  FROM month_orders GROUP BY ALL
),
stg_prices AS (
  SELECT m AS mes, y AS ano, n_name AS empresa, c_mktsegment AS tarifa,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(n AS DOUBLE) END AS abonados,
    CASE WHEN NOT (c_mktsegment = 'BUILDING' AND m = 6) THEN CAST(s AS DOUBLE) END AS ventas,
    CAST(s AS DOUBLE) AS ingreso_con_cvg, CAST(n AS DOUBLE) AS precio_medio_con_cvg,
    'T' || CAST((m + 2) // 3 AS VARCHAR) AS trimestre, o_orderstatus AS sistema
  FROM price_groups WHERE NOT (o_orderstatus = 'P' AND m = 2)
)
"""


# ---- climate as landed --------------------------------------------------------------

def climate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, supplier, nation = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    grouped = (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"))
        .agg(
            money_sum("l_quantity").alias("q"),
            money_sum("l_discount").alias("d"),
            F.count(F.lit(1)).alias("n"),
            F.max("l_quantity").alias("q_max"),
            F.min("l_quantity").alias("q_min"),
        )
    )
    mean = F.col("q").cast("double") / F.col("n")
    values = {
        "T2M": mean,
        "WS10M": F.when(F.col("m") == 5, F.lit(-999.0)).otherwise(F.col("d").cast("double")),
        "CLOUD_AMT": F.col("n").cast("double"),
        "RH2M": F.col("d").cast("double") / F.col("n"),
        "T2M_MAX": F.col("q_max"),
        "T2M_MIN": F.col("q_min"),
    }
    others = [v for v in schemas.CLIMATE_VARIABLES if v not in values]
    values |= {v: F.col("n") + F.lit(float(i)) for i, v in enumerate(others)}
    return grouped.select(
        F.lower("n_name").alias("Empresa"),
        F.col("y").cast("string").alias("Año"),
        F.col("m").cast("string").alias("Mes"),
        *[values[v].alias(v) for v in schemas.CLIMATE_VARIABLES],
    )


_OTHERS = [v.lower() for v in schemas.CLIMATE_VARIABLES[6:]]
CLIMATE = f"""
climate_groups AS (
  SELECT n_name, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q,
    CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS d,
    CAST(count(*) AS DOUBLE) AS n, max(l_quantity) AS q_max, min(l_quantity) AS q_min
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL
),
stg_climate AS (
  SELECT n_name AS empresa, y AS ano, m AS mes, q / n AS t2m,
    CASE WHEN m = 5 THEN -999e0 ELSE d END AS ws10m, n AS cloud_amt, d / n AS rh2m,
    q_max AS t2m_max, q_min AS t2m_min,
    {", ".join(f"n + {i}e0 AS {v}" for i, v in enumerate(_OTHERS))}
  FROM climate_groups
)
"""


# ---- plants, zones, distribution, fuels ---------------------------------------------

def plants_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    key = F.col("s_suppkey")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("int").alias("id_Objecto"),
            F.col("n_name").alias("operador"),
            F.col("s_name").alias("centralElectrica"),
            text.lookup((key % 4).cast("int"), SOURCES).alias("fuente"),
            F.col("r_name").alias("provincia"),
            F.col("n_name").alias("canton"),
            F.lit(None).cast("string").alias("distrito"),
            (F.col("n_nationkey") * 100).alias("codigoDTA"),
            (F.lit(350000.0) + F.col("s_acctbal") * 30).alias("coordenadaX"),
            (F.lit(1000000.0) + (key % 50) * 1000).alias("coordenadaY"),
        )
    )


PLANTS = """
plants AS (
  SELECT CAST(s_suppkey AS INTEGER) AS id_objecto, n_name AS operador, s_name AS central_electrica,
    CASE s_suppkey % 4 WHEN 0 THEN 'HIDRICA' WHEN 1 THEN 'EOLICA' WHEN 2 THEN 'SOLAR'
      ELSE 'TERMICA' END AS fuente,
    r_name AS provincia, n_name AS canton, CAST(n_nationkey * 100 AS INTEGER) AS codigo_dta,
    350000e0 + s_acctbal * 30e0 AS x, 1000000e0 + CAST(s_suppkey % 50 * 1000 AS DOUBLE) AS y
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)
"""


def zones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = (table(spark, sf_dir, t) for t in ("customer", "nation"))
    key = F.col("c_custkey")
    square = F.concat(
        F.lit("(("), F.col("x"), F.lit(" "), F.col("y"), F.lit(", "),
        F.col("x") + 1000, F.lit(" "), F.col("y"), F.lit(", "),
        F.col("x") + 1000, F.lit(" "), F.col("y") + 1000, F.lit(", "),
        F.col("x"), F.lit(" "), F.col("y"), F.lit("))"),
    )
    dot = F.concat(F.lit("point ("), F.col("x"), F.lit(" "), F.col("y"), F.lit(")"))
    wkt = (
        F.when(key % 7 == 0, dot)
        .when(key % 5 == 0, F.concat(F.lit("MULTIPOLYGON("), square, F.lit(", "), square, F.lit(")")))
        .otherwise(F.concat(F.lit("POLYGON "), square))
    )
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns({"x": key * 37 % 200000 + 300000, "y": key * 53 % 250000 + 950000})
        .select(
            key.cast("int").alias("id_Objecto"),
            F.when(key % 3 == 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")))
            .otherwise(F.col("n_name"))
            .alias("operador"),
            F.col("c_name").alias("descripcion"),
            F.col("c_acctbal").alias("area"),
            wkt.alias("coordenadas"),
        )
    )


ZONES = """
zones AS (
  SELECT CAST(c_custkey AS INTEGER) AS id_objecto,
    CASE WHEN c_custkey % 3 = 0 THEN ' ' || lower(n_name) || ' ' ELSE n_name END AS operador,
    n_name, c_name AS descripcion, c_acctbal AS area,
    c_custkey * 37 % 200000 + 300000 AS x, c_custkey * 53 % 250000 + 950000 AS y,
    CASE WHEN c_custkey % 7 = 0 THEN 'POINT' WHEN c_custkey % 5 = 0 THEN 'MULTIPOLYGON'
      ELSE 'POLYGON' END AS tipo_geometria
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)
"""


def distribution_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = _month_orders(spark, sf_dir).groupBy(
        "n_name", "o_orderpriority", "c_mktsegment", "o_orderstatus", "y", "m"
    ).agg(money_sum("o_totalprice").alias("s"), F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    return grouped.select(
        F.col("m").alias("id_Mes"),
        text.month_name(F.col("m")).alias("mes"),
        F.col("y").alias("anho"),
        none.alias("fecha"),
        F.col("n_name").alias("empresa"),
        F.col("o_orderpriority").alias("tipoTarifa"),
        F.col("c_mktsegment").alias("descripcionTarifa"),
        F.col("o_orderstatus").alias("bloque"),
        (F.col("s").cast("double") / (F.col("n") + F.lit(0.3))).alias("tarifaPromedio"),
        F.when(F.col("m") > 1, F.col("n").cast("double")).alias("tarifa"),
        none.alias("pliego"),
    )


DISTRIBUTION = """
stg_dist AS (
  SELECT m AS id_mes, y AS anho, n_name AS empresa, o_orderpriority AS tipo_tarifa,
    c_mktsegment AS descripcion_tarifa, o_orderstatus AS bloque,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / (count(*) + 0.3e0) AS tarifa_promedio
  FROM month_orders GROUP BY ALL
)
"""


def fuels_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = (table(spark, sf_dir, t) for t in ("lineitem", "part"))
    grouped = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("d"), "p_type")
        .agg(
            money_sum("l_quantity").alias("q"),
            F.max("l_extendedprice").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    given = {
        "numeroExpediente": F.concat(F.lit("ET-"), "l_returnflag"),
        "numeroResolucion": F.concat(F.lit("RE-"), "l_linestatus"),
        "fechaPublicacion": F.col("d").cast("string"),
        "alcanceGaceta": F.lit("ALCANCE"),
        "numeroGaceta": F.month("d"),
        "producto": F.col("p_type"),
        "tipoCambio": F.col("q").cast("double"),
        "precioFinal": F.col("top"),
        "canon": F.when(F.col("n") > 1, F.col("n").cast("double")),
        "rige": F.when(F.col("l_returnflag") == "A", "Sí")
        .when(F.col("l_returnflag") == "N", " no")
        .otherwise(""),
        "observaciones": F.lit("x"),
        "idSIET": F.lit(1),
    }
    others = {f.source: F.col("n") * F.lit(float(k)) for k, f in OTHER_FUELS.items()}
    return grouped.select(*[c.alias(n) for n, c in {**given, **others}.items()])


# Measures that get a multiple of the row count, each its own.
OTHER_FUELS = {
    k: f for k, f in enumerate(schemas.FUELS)
    if f.type == "double" and f.source not in ("tipoCambio", "precioFinal", "canon")
}
_OTHERS = ", ".join(f"CAST(count(*) * {k} AS DOUBLE) AS {f.name}" for k, f in OTHER_FUELS.items())
FUELS = f"""
stg_fuels AS (
  SELECT 'ET-' || l_returnflag AS numero_expediente, 'RE-' || l_linestatus AS numero_resolucion,
    CAST(l_shipdate AS DATE) AS fecha_publicacion, p_type AS producto,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS tipo_cambio,
    max(l_extendedprice) AS precio_final,
    CASE WHEN count(*) > 1 THEN CAST(count(*) AS DOUBLE) ELSE 0e0 END AS canon,
    CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false END AS rige, {_OTHERS},
    CAST(month(l_shipdate) AS INTEGER) AS numero_gaceta
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_returnflag, l_linestatus, CAST(l_shipdate AS DATE), p_type, month(l_shipdate)
)
"""

STAGED = ",".join([PRICES, CLIMATE, PLANTS, ZONES, DISTRIBUTION, FUELS])


# ---- staging frames through the recipes ---------------------------------------------

def staging(spark: SparkSession, sf_dir: str, only: tuple[str, ...] | None = None):
    """Staging tables of the stand-ins, stored once, side by side; ``only`` leaves the others empty."""
    build = {
        "stg_clima_nasa": lambda: recipes.prepare_climate(
            clean_climate_keys(climate_raw(spark, sf_dir))
        ),
        "stg_aresep_medios": lambda: recipes.prepare_prices(
            recipes.clean_prices(prices_raw(spark, sf_dir))
        ),
        "stg_centro": lambda: recipes.prepare_plants(plants_raw(spark, sf_dir)),
        "stg_zonas": lambda: recipes.prepare_zones(zones_raw(spark, sf_dir)),
        "stg_distribucion": lambda: recipes.prepare_distribution(distribution_raw(spark, sf_dir)),
        "stg_hidrocarburos": lambda: recipes.prepare_fuels(fuels_raw(spark, sf_dir)),
    }
    wanted = [name for name in schemas.STAGING if only is None or name in only]
    shared_dir(spark)  # set once, before the threads ask for it
    with ThreadPoolExecutor(max(1, len(wanted))) as pool:
        store = lambda name: materialise(to_model(build[name](), schemas.STAGING[name]))
        running = {name: pool.submit(inheritable_thread_target(spark)(store), name) for name in wanted}
        stored = {name: future.result() for name, future in running.items()}
    empty = lambda fields: empty_frame(spark, schemas.staging_schema(fields))
    return {name: stored[name] if name in stored else empty(fields) for name, fields in schemas.STAGING.items()}
