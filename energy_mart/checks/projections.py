"""Scalar expressions, projections and filters."""

from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.checks import standins as st
from energy_mart.checks.registry import check
from energy_mart.functions import dates, numbers, text
from energy_mart.functions.geo import with_lon_lat
from energy_mart.operators import filters, project
from energy_mart.plans import recipes


@check("p1_layout", """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
""")
def layout(spark, sf):
    wanted = ["o_orderpriority", "not_there", "o_orderkey", "o_totalprice"]
    return project.keep_existing(st.table(spark, sf, "orders"), wanted)


@check("p2_drop_columns", """
SELECT * EXCLUDE (l_tax, l_discount, l_shipdate) FROM lineitem
""")
def drop(spark, sf):
    return project.drop_columns(st.table(spark, sf, "lineitem"), ["l_tax", "l_discount", "l_shipdate"])


@check("p3_alias_model", """
SELECT CAST(s_suppkey AS INTEGER) AS id_objecto, s_name AS operador,
  CAST(NULL AS VARCHAR) AS descripcion, CAST(s_acctbal AS DECIMAL(18,8)) AS area,
  CAST(NULL AS VARCHAR) AS coordenadas, CAST(NULL AS VARCHAR) AS tipo_geometria
FROM supplier
""")
def alias_model(spark, sf):
    rows = st.table(spark, sf, "supplier").withColumnsRenamed(
        {"s_suppkey": "id_Objecto", "s_name": "operador", "s_acctbal": "area"}
    )
    return project.to_model(rows, schemas.ZONES)


@check("p5_trim_names", "SELECT n_nationkey, n_name FROM nation")
def trim_names(spark, sf):
    rows = st.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias(" n_nationkey "), F.col("n_name").alias("n_name  ")
    )
    return project.trim_names(rows)


@check("p6_convert", """
SELECT event_id, CAST(props->>'$.k' AS DOUBLE) AS as_int, CAST(value AS VARCHAR) AS as_text_in,
  value AS as_float, CASE WHEN event_id % 2 = 0 THEN true END AS as_bool,
  CASE WHEN event_id % 3 > 0 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS as_time
FROM events
""")
def convert(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = st.table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("as_int"),
        F.col("value").cast("string").alias("as_text_in"),
        F.col("value").cast("string").alias("as_float"),
        F.when(F.col("event_id") % 2 == 0, " Si").otherwise("  ").alias("as_bool"),
        F.when(F.col("event_id") % 3 > 0, day).otherwise("no date").alias("as_time"),
    )
    for name, kind in (
        ("as_int", "int"), ("as_float", "float"), ("as_bool", "bool"), ("as_time", "datetime"),
        ("as_text_in", "other"),
    ):
        rows = project.convert(rows, [name], kind)
    return rows


@check("p7_lenient_number", """
SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '([0-9]+)', 1), '') AS DOUBLE) AS found,
  CAST(NULL AS DOUBLE) AS word, CAST(n_chars AS DOUBLE) AS padded
FROM documents
""")
def lenient(spark, sf):
    rows = st.table(spark, sf, "documents")
    return rows.select(
        "doc_id",
        numbers.lenient_double(F.regexp_extract("text", "([0-9]+)", 1)).alias("found"),
        numbers.lenient_double(F.col("lang")).alias("word"),
        numbers.lenient_double(F.concat(F.lit(" "), "n_chars", F.lit("\t"))).alias("padded"),
    )


@check("p8_normalise_values", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN l_tax END AS tax,
  CAST(l_shipdate AS DATE) AS ship_day
FROM lineitem
""")
def normalise(spark, sf):
    tax = F.when(F.col("l_discount") > 0, F.col("l_tax")).otherwise(F.lit(float("nan")))
    return st.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.nan_to_null(tax).alias("tax"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
    )


@check("p9_boolean_text", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS flag,
  o_orderstatus = 'P' AND o_orderkey % 2 = 0 AS bad
FROM orders
""")
def boolean_text(spark, sf):
    word = (
        F.when(F.col("o_orderstatus") == "O", " SÍ ")
        .when(F.col("o_orderstatus") == "F", "No")
        .when(F.col("o_orderkey") % 2 == 0, "tal vez")
        .otherwise("  ")
    )
    return st.table(spark, sf, "orders").select(
        "o_orderkey", text.boolean_text(word).alias("flag"), text.is_bad_boolean(word).alias("bad")
    )


@check("p10_period_season", f"""
WITH {st.WIDE}
SELECT row_id, periodo, estacion,
  CAST(CASE WHEN periodo LIKE 'Antes%' THEN 0 WHEN periodo LIKE 'Medio%' THEN 1 ELSE 2 END AS INTEGER)
    AS orden
FROM base
""")
def period_season(spark, sf):
    label = dates.period_label(F.col("ano"), st.PERIODS, st.LAST_PERIOD)
    return st.wide(spark, sf).select(
        "row_id",
        label.alias("periodo"),
        dates.season_label(F.col("mes")).alias("estacion"),
        dates.period_order(label, st.PERIODS, st.LAST_PERIOD).alias("orden"),
    )


@check("p11_label_map", """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Auto' WHEN 'BUILDING' THEN 'Building'
  WHEN 'FURNITURE' THEN 'Furniture' WHEN 'MACHINERY' THEN 'Machinery' END AS etiqueta
FROM customer
""")
def label_map(spark, sf):
    return st.table(spark, sf, "customer").select(
        "c_custkey", text.tariff_label(F.col("c_mktsegment"), st.LABELS).alias("etiqueta")
    )


@check("p12_month_number", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND month(o_orderdate) = 3 THEN NULL
  ELSE CAST(month(o_orderdate) AS INTEGER) END AS mes FROM orders
""")
def month_number(spark, sf):
    name = text.lookup(F.month("o_orderdate"), st.UPPER_MONTHS)
    september = F.when(F.col("o_orderkey") % 2 == 0, "setiembre").otherwise(" Septiembre ")
    dirty = (
        F.when((F.col("o_orderstatus") == "P") & (F.month("o_orderdate") == 3), "MARCH")
        .when(F.month("o_orderdate") == 9, september)
        .otherwise(F.concat(F.lit(" "), F.initcap(name), F.lit("\n")))
    )
    return st.table(spark, sf, "orders").select("o_orderkey", text.month_number(dirty).alias("mes"))


@check("p13_operator_code", """
SELECT n_name, count(*) AS clientes FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_nationkey < 20 GROUP BY n_name
""")
def operator_code(spark, sf):
    rows = st.table(spark, sf, "customer").join(
        st.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    code = text.company_code(F.concat(F.lit(" "), "n_name", F.lit(" ")), st.CODES)
    coded = rows.select(code.alias("n_name")).dropna()
    return coded.groupBy("n_name").agg(F.count(F.lit(1)).alias("clientes"))


@check("p14_sentinel", f"WITH {st.WIDE} SELECT row_id, t2m, prectotcorr FROM base")
def sentinel(spark, sf):
    rows = st.wide(spark, sf).select("row_id", "t2m", "prectotcorr")
    return project.clear_sentinel(rows, ["t2m", "prectotcorr"])


@check("p15_swap_zero_null", """
SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount, l_tax,
  CASE WHEN l_quantity > 25 THEN l_quantity ELSE 0 END AS large
FROM lineitem
""")
def swap(spark, sf):
    rows = st.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax",
        F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("large"),
    )
    return project.swap_zero_null(project.swap_zero_null(rows, "l_discount"), ["large"], to_zero=True)


@check("p16_date_columns", """
SELECT o_orderkey, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS fecha,
  CAST(year(o_orderdate) AS INTEGER) AS fecha_year,
  CAST(month(o_orderdate) AS INTEGER) AS fecha_month
FROM orders
""")
def date_columns(spark, sf):
    rows = st.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha")
    )
    return project.add_date_parts(rows, "fecha")


@check("p17_month_date", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 15 BETWEEN 1 AND 12
    THEN make_date(CAST(year(o_orderdate) AS INTEGER), CAST(o_orderkey % 15 AS INTEGER), 1) END AS fecha,
  CASE WHEN month(o_orderdate) < 12
    THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS fecha_ym
FROM orders
""")
def month_date(spark, sf):
    month = F.month("o_orderdate")
    key = F.format_string("%d%02d", F.year("o_orderdate"), F.when(month == 12, 13).otherwise(month))
    return st.table(spark, sf, "orders").select(
        "o_orderkey",
        dates.month_date(F.year("o_orderdate"), (F.col("o_orderkey") % 15).cast("int")).alias("fecha"),
        dates.yyyymm_date(key).alias("fecha_ym"),
    )


@check("p18_split_token", r"""
WITH w AS (
  SELECT conv_id, turn, regexp_split_to_array(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS t
  FROM conversations
)
SELECT conv_id, turn, t[1] AS primero,
  CASE WHEN len(t) = 1 THEN NULL ELSE array_to_string(t[2:], ' ') END AS resto,
  t[len(t)] AS ultimo, CASE WHEN len(t) >= 10 THEN t[10] END AS decimo,
  array_to_string(CASE WHEN len(t) >= 10 THEN t[1:9] || t[11:] ELSE t END, ' ') AS sin_decimo
FROM w
""")
def split_token(spark, sf):
    rows = st.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    rows = project.split_token(rows, "text", 0, "primero", "resto", drop=False)
    rows = project.split_token(rows, "text", -1, "ultimo", drop=False)
    return project.split_token(rows, "text", 9, "decimo", "sin_decimo")


LON_LAT = """
k AS (
  SELECT *, 0.0066943799901413165e0 AS e2, 0.006739496742276434e0 AS ep2, 0.0016792203863837047e0 AS n1
  FROM plants
),
mu AS (
  SELECT *, y / (6378137e0 * 0.9999e0 * (1 - e2/4 - 3*pow(e2,2)/64 - 5*pow(e2,3)/256)) AS mu FROM k
),
fp AS (
  SELECT *, mu + (3*n1/2 - 27*pow(n1,3)/32)*sin(2*mu) + (21*pow(n1,2)/16 - 55*pow(n1,4)/32)*sin(4*mu)
    + (151*pow(n1,3)/96)*sin(6*mu) + (1097*pow(n1,4)/512)*sin(8*mu) AS f FROM mu
),
aux AS (
  SELECT *, ep2*pow(cos(f),2) AS c, pow(tan(f),2) AS t,
    6378137e0/sqrt(1 - e2*pow(sin(f),2)) AS nn,
    6378137e0*(1-e2)/pow(1 - e2*pow(sin(f),2), 1.5e0) AS rr FROM fp
),
dd AS (SELECT *, (x - 500000e0)/(nn*0.9999e0) AS d FROM aux),
lonlat AS (
  SELECT *, round(degrees(f - (nn*tan(f)/rr)*(pow(d,2)/2
      - (5 + 3*t + 10*c - 4*pow(c,2) - 9*ep2)*pow(d,4)/24
      + (61 + 90*t + 298*c + 45*pow(t,2) - 252*ep2 - 3*pow(c,2))*pow(d,6)/720)), 7) AS lat,
    round(-84 + degrees((d - (1 + 2*t + c)*pow(d,3)/6
      + (5 - 2*c + 28*t - 3*pow(c,2) + 8*ep2 + 24*pow(t,2))*pow(d,5)/120)/cos(f)), 7) AS lon
  FROM dd
)
"""


@check("p19_reproject", f"""
WITH {st.PLANTS}, {LON_LAT}
SELECT id_objecto, lon, lat FROM lonlat
""")
def reproject(spark, sf):
    rows = with_lon_lat(st.plants_raw(spark, sf), "coordenadaX", "coordenadaY", "lon", "lat")
    return rows.select(
        F.col("id_Objecto").alias("id_objecto"), F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat")
    )


@check("p20_calendar", f"""
WITH {st.PRICES}
SELECT o_orderkey, y AS anio, m AS mes, CAST(day(o_orderdate) AS INTEGER) AS dia,
  CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
  upper(month_name[1]) || lower(month_name[2:]) AS nombre_mes, y * 100 + m AS anio_mes
FROM month_orders JOIN month_names USING (m)
""")
def calendar(spark, sf):
    parts = dates.date_parts(F.col("o_orderdate"))
    return st.table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@check("p21_natural_key", """
SELECT o_orderkey, 'MEDIOS|' || o_orderpriority || '|' ||
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END || '|' || CAST(o_custkey AS VARCHAR) AS nk
FROM orders
""")
def natural_key(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    key = text.natural_key(F.col("o_orderpriority"), status, F.col("o_custkey"), prefix="MEDIOS")
    return st.table(spark, sf, "orders").select("o_orderkey", key.alias("nk"))


@check("p22_geometry_class", f"""
WITH {st.ZONES} SELECT id_objecto, tipo_geometria FROM zones
UNION ALL SELECT CAST(NULL AS INTEGER), 'DESCONOCIDO' FROM documents
""")
def geometry(spark, sf):
    zones = st.zones_raw(spark, sf).select(F.col("id_Objecto").alias("id_objecto"), "coordenadas")
    others = st.table(spark, sf, "documents").select(
        F.lit(None).cast("int").alias("id_objecto"), F.col("lang").alias("coordenadas")
    )
    every = project.stack_by_name([zones, others])
    return every.select("id_objecto", text.geometry_class(F.col("coordenadas")).alias("tipo_geometria"))


@check("p23_numeric_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def numeric(spark, sf):
    orders = st.table(spark, sf, "orders")
    return orders.select(*project.numeric_columns(orders))


@check("p26_display_format", """
SELECT l_orderkey, l_linenumber, format('{:,.2f}', l_extendedprice) AS precio,
  format('{:,}', l_orderkey) AS clave, format('{:.2f}%', l_discount * 100) AS descuento
FROM lineitem
""")
def display(spark, sf):
    return st.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        text.thousands(F.col("l_extendedprice"), 2).alias("precio"),
        text.thousands(F.col("l_orderkey")).alias("clave"),
        text.percent_text(F.col("l_discount") * 100).alias("descuento"),
    )


@check("p27_scaling", """
SELECT l_shipdate, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1e6, 3) AS millones
FROM lineitem GROUP BY l_shipdate
""")
def scaling(spark, sf):
    sums = st.table(spark, sf, "lineitem").groupBy("l_shipdate").agg(
        st.money_sum("l_extendedprice").cast("double").alias("s")
    )
    return sums.select("l_shipdate", numbers.scaled(F.col("s"), 1e6, 3).alias("millones"))


@check("p28_clean_keys", """
SELECT doc_id, upper(lang) AS lang, upper(source) AS source FROM documents
""")
def clean_keys(spark, sf):
    return st.table(spark, sf, "documents").select(
        "doc_id",
        text.clean_key(F.concat(F.lit(" \t"), "lang", F.lit("\n"))).alias("lang"),
        text.clean_key(F.concat("source", F.lit("  "))).alias("source"),
    )


@check("p29_zone_label", """
SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'Heredia' WHEN 1 THEN 'Cartago'
  ELSE 'Zona no definida' END AS zona FROM customer
""")
def zone_label(spark, sf):
    name = F.when(F.col("c_nationkey") == 0, " esph").when(F.col("c_nationkey") == 1, "Jasec ")
    return st.table(spark, sf, "customer").select(
        "c_custkey", text.zone_label(name.otherwise("X")).alias("zona")
    )


@check("p30_first_non_null", """
SELECT doc_id, coalesce(CAST(quality AS VARCHAR), lang) AS etiqueta
FROM documents LEFT JOIN labels USING (doc_id)
""")
def first_non_null(spark, sf):
    joined = st.table(spark, sf, "documents").join(st.table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", F.coalesce(F.col("quality").cast("string"), "lang").alias("etiqueta"))


# ---- filters ------------------------------------------------------------------------

@check("f1_complete_rows", f"""
WITH {st.WIDE} SELECT row_id, abonados, t2m FROM base WHERE abonados IS NOT NULL AND t2m IS NOT NULL
""")
def complete_rows(spark, sf):
    rows = project.clear_sentinel(st.wide(spark, sf).select("row_id", "abonados", "t2m"), ["t2m"])
    return filters.complete_rows(rows)


@check("f2_complete_subset", f"""
WITH {st.WIDE} SELECT row_id, abonados, t2m FROM base WHERE abonados IS NOT NULL
""")
def complete_subset(spark, sf):
    rows = project.clear_sentinel(st.wide(spark, sf).select("row_id", "abonados", "t2m"), ["t2m"])
    return filters.complete_rows(rows, ["abonados"])


@check("f3_clean_prices", f"""
WITH {st.PRICES}
SELECT mes, ano, upper(empresa) AS empresa, tarifa, abonados, ventas, ingreso_con_cvg,
  precio_medio_con_cvg, trimestre, sistema FROM stg_prices
""")
def clean_prices(spark, sf):
    cleaned = recipes.clean_prices(st.prices_raw(spark, sf))
    return project.to_model(cleaned, schemas.PRICES).drop(
        "ingreso_sin_cvg", "precio_medio_sin_cvg", "trimestral"
    )


@check("f5_outside_range", """
SELECT event_id, value FROM events WHERE value <= 1 OR value >= 100
""")
def outside(spark, sf):
    rows = st.table(spark, sf, "events").select("event_id", "value")
    return filters.outside_range(rows, "value", 1, 100)


@check("f6_by_date_parts", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5
""")
def date_filter(spark, sf):
    rows = st.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return filters.by_date_parts(rows, "o_orderdate", year=1997, month=5)


@check("f7_chosen", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def chosen(spark, sf):
    rows = st.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return filters.chosen(rows, o_orderstatus=["O", "F"], o_orderpriority=["1-URGENT", "2-HIGH"])


@check("f9_sql_predicates", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE month(o_orderdate) BETWEEN 1 AND 6 AND o_orderpriority NOT IN ('5-LOW')
  AND o_totalprice > 0 AND trim(o_orderstatus) <> '' AND o_custkey IS NOT NULL
""")
def predicates(spark, sf):
    return st.table(spark, sf, "orders").filter(
        F.month("o_orderdate").between(1, 6)
        & ~F.col("o_orderpriority").isin("5-LOW")
        & (F.col("o_totalprice") > 0)
        & (F.trim("o_orderstatus") != "")
        & F.col("o_custkey").isNotNull()
    ).select("o_orderkey", "o_orderdate")
