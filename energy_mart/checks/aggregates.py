"""Aggregates, shares, sorts, joins and set operations."""

from pyspark.sql import functions as F

from energy_mart.checks import standins as st
from energy_mart.checks.profiling import base, rounded
from energy_mart.checks.registry import check
from energy_mart.functions.text import MONTH_LABELS
from energy_mart.operators import aggregate
from energy_mart.operators.merge import absent_rows
from energy_mart.operators.project import stack_by_name
from energy_mart.plans import recipes, reports
from energy_mart.sources.climate import clean_climate_keys


@check("a2_total_reconciliation", f"""
WITH {st.PRICES}, total AS (SELECT y, m, sum(s) AS s FROM price_groups GROUP BY ALL),
parts AS (SELECT y, m, sum(s) AS s FROM price_groups WHERE NOT (o_orderstatus = 'P' AND m = 2) GROUP BY ALL),
j AS (
  SELECT y, m, CAST(p.s AS DOUBLE) AS parts, CAST(t.s + m * 1100 AS DOUBLE) AS published
  FROM total t JOIN parts p USING (y, m) WHERE m <> 12
)
SELECT y AS ano, CASE WHEN m % 2 = 0 THEN ' ' || lower(month_name) ELSE month_name END AS mes,
  round(parts, 2) AS parts, round(published, 2) AS published,
  round(published - parts, 2) AS difference,
  round((published - parts) / 1e6, 2) AS difference_millions,
  round((published - parts) / published * 100, 2) AS difference_pct
FROM j JOIN month_names USING (m)
""")
def reconciliation(spark, sf):
    rows = recipes.price_reconciliation(st.prices_raw(spark, sf))
    return rounded(rows, 2, "parts", "published", "difference")


@check("a2_reconciliation_text", f"""
WITH {st.PRICES}, total AS (SELECT y, m, sum(s) AS s FROM price_groups GROUP BY ALL),
parts AS (SELECT y, m, sum(s) AS s FROM price_groups WHERE NOT (o_orderstatus = 'P' AND m = 2) GROUP BY ALL),
j AS (
  SELECT y, m, CAST(p.s AS DOUBLE) AS parts, CAST(t.s + m * 1100 AS DOUBLE) AS published
  FROM total t JOIN parts p USING (y, m) WHERE m <> 12
)
SELECT y AS ano, CASE WHEN m % 2 = 0 THEN ' ' || lower(month_name) ELSE month_name END AS mes,
  format('{{:,.0f}}', parts) AS parts, format('{{:,.0f}}', published) AS published,
  format('{{:,.0f}}', published - parts) AS difference,
  format('{{:,.2f}}', round((published - parts) / 1e6, 2)) AS difference_millions,
  format('{{:.2f}}%', round((published - parts) / published * 100, 2)) AS difference_pct
FROM j JOIN month_names USING (m) ORDER BY ano, mes LIMIT 12
""")
def reconciliation_text(spark, sf):
    rows = recipes.price_reconciliation(st.prices_raw(spark, sf))
    return recipes.reconciliation_text(rows)


@check("a3_key_figures", f"""
WITH {st.WIDE}
SELECT round(sum(ventas), 2) AS ventas_total, round(sum(ingreso_con_cvg), 2) AS ingreso_total,
  round(avg(precio_medio_con_cvg), 6) AS precio_promedio, round(avg(t2m), 6) AS temperatura_promedio
FROM base
""")
def key_figures(spark, sf):
    rows = rounded(reports.key_figures(base(spark, sf)), 2, "ventas_total", "ingreso_total")
    return rounded(rows, 6, "precio_promedio", "temperatura_promedio")


@check("a4_yearly_totals", f"""
WITH {st.WIDE}
SELECT ano, round(sum(ventas), 2) AS ventas, round(sum(ingreso_con_cvg), 2) AS ingreso
FROM base GROUP BY ano
""")
def yearly(spark, sf):
    return rounded(reports.yearly_totals(base(spark, sf)), 2, "ventas", "ingreso")


@check("a5_sales_by_company", f"""
WITH {st.WIDE} SELECT empresa, round(sum(ventas), 2) AS ventas FROM base GROUP BY empresa
""")
def by_company(spark, sf):
    return rounded(reports.sales_by(base(spark, sf), "empresa", True), 2, "ventas")


def _month_columns(value, digits):
    return ", ".join(
        f"round(avg({value}) FILTER (WHERE mes = {i}), {digits}) AS {label}"
        for i, label in enumerate(MONTH_LABELS, 1)
    )


@check("a6_company_month_matrix", f"""
WITH {st.WIDE} SELECT empresa, {_month_columns("ventas", 4)} FROM base GROUP BY empresa
""")
def company_months(spark, sf):
    return rounded(reports.company_month_matrix(base(spark, sf)), 4, *MONTH_LABELS)


@check("a7_tariff_month_matrix", f"""
WITH {st.WIDE} SELECT tarifa, {_month_columns("ventas", 4)} FROM base
WHERE empresa = 'NATION_3' GROUP BY tarifa
""")
def tariff_months(spark, sf):
    return rounded(reports.tariff_month_matrix(base(spark, sf), "NATION_3"), 4, *MONTH_LABELS)


@check("a8_period_means", f"""
WITH {st.WIDE}
SELECT periodo, tarifa_label, round(avg(ventas), 4) AS ventas,
  CAST(CASE WHEN periodo LIKE 'Antes%' THEN 0 WHEN periodo LIKE 'Medio%' THEN 1 ELSE 2 END AS INTEGER)
    AS periodo_ord
FROM base WHERE tarifa_label IS NOT NULL GROUP BY periodo, tarifa_label
""")
def period_means(spark, sf):
    rows = reports.period_means(base(spark, sf), st.LABELS, st.PERIODS, st.LAST_PERIOD)
    return rounded(rows, 4, "ventas")


@check("a8_period_change", f"""
WITH {st.WIDE}, p AS (
  SELECT tarifa_label, avg(ventas) FILTER (WHERE periodo LIKE 'Antes%') AS a,
    avg(ventas) FILTER (WHERE periodo LIKE 'Medio%') AS b,
    avg(ventas) FILTER (WHERE periodo LIKE 'Despues%') AS c
  FROM base WHERE tarifa_label IS NOT NULL GROUP BY tarifa_label
)
SELECT tarifa_label, round(a, 4) AS antes, round(b, 4) AS medio, round(c, 4) AS despues,
  round((b - a) / a * 100, 1) AS var_pct FROM p
""")
def period_change(spark, sf):
    rows = reports.period_change(base(spark, sf), st.LABELS, st.PERIODS, st.LAST_PERIOD)
    names = dict(zip([*st.PERIODS, st.LAST_PERIOD], ("antes", "medio", "despues")))
    return rounded(rows.withColumnsRenamed(names), 4, "antes", "medio", "despues")


@check("a9_yearly_tariff_means", f"""
WITH {st.WIDE}
SELECT ano, tarifa, round(avg(ventas), 4) AS ventas FROM base
WHERE tarifa IN ('BUILDING', 'MACHINERY') GROUP BY ano, tarifa
""")
def yearly_tariffs(spark, sf):
    rows = reports.yearly_tariff_means(base(spark, sf), ["BUILDING", "MACHINERY"])
    return rounded(rows, 4, "ventas")


@check("a10_season_months", f"""
WITH {st.WIDE}
SELECT estacion, mes, round(avg(ventas), 4) AS ventas, round(avg(t2m), 6) AS t2m FROM base
WHERE tarifa = 'BUILDING' GROUP BY estacion, mes
""")
def season_months(spark, sf):
    rows = reports.season_months(base(spark, sf), "BUILDING")
    return rounded(rounded(rows, 4, "ventas"), 6, "t2m")


@check("a11_season_temperature", f"""
WITH {st.WIDE}, s AS (
  SELECT empresa, round(avg(t2m) FILTER (WHERE estacion LIKE 'Verano%'), 1) AS verano,
    round(avg(t2m) FILTER (WHERE estacion LIKE 'Lluvioso%'), 1) AS lluvioso FROM base GROUP BY empresa
)
SELECT empresa, verano, lluvioso, round(verano - lluvioso, 1) AS diferencia FROM s
""")
def season_temperature(spark, sf):
    return rounded(reports.season_temperature(base(spark, sf)), 1, "diferencia")


@check("a12_tariff_comparison", f"""
WITH {st.WIDE}, s AS (
  SELECT tarifa, avg(ventas) FILTER (WHERE ano IN (1995, 1996)) AS a,
    avg(ventas) FILTER (WHERE ano IN (1997, 1998)) AS b
  FROM base WHERE tarifa IN ('BUILDING', 'FURNITURE') GROUP BY tarifa
)
SELECT tarifa, round(a, 4) AS mean_first, round(b, 4) AS mean_second,
  round((b - a) / a * 100, 6) AS change_pct FROM s
""")
def tariff_comparison(spark, sf):
    rows = reports.tariff_comparison(
        base(spark, sf), ["BUILDING", "FURNITURE"], [1995, 1996], [1997, 1998]
    )
    return rounded(rounded(rows, 4, "mean_first", "mean_second"), 6, "change_pct")


@check("a12_season_comparison", f"""
WITH {st.WIDE}, s AS (
  SELECT avg(ventas) FILTER (WHERE estacion LIKE 'Lluvioso%') AS a,
    avg(ventas) FILTER (WHERE estacion LIKE 'Verano%') AS b FROM base
)
SELECT round(a, 4) AS mean_first, round(b, 4) AS mean_second, round((b - a) / a * 100, 6) AS change_pct
FROM s
""")
def season_comparison(spark, sf):
    rows = reports.season_comparison(base(spark, sf))
    return rounded(rounded(rows, 4, "mean_first", "mean_second"), 6, "change_pct")


@check("a12_regional_figures", f"""
WITH {st.WIDE}, s AS (
  SELECT avg(t2m) FILTER (WHERE empresa = 'NATION_1') AS t1,
    avg(t2m) FILTER (WHERE empresa = 'NATION_2') AS t2,
    avg(ventas) FILTER (WHERE empresa = 'NATION_1' AND estacion LIKE 'Verano%') AS v,
    avg(ventas) FILTER (WHERE empresa = 'NATION_1' AND estacion LIKE 'Lluvioso%') AS l FROM base
)
SELECT round(t1, 6) AS t2m_first, round(t2, 6) AS t2m_second, round(v, 4) AS ventas_verano,
  round(l, 4) AS ventas_lluvioso, round((v - l) / l * 100, 6) AS dif_pct FROM s
""")
def regional(spark, sf):
    rows = reports.regional_figures(base(spark, sf), "NATION_1", "NATION_2")
    rows = rounded(rows, 6, "t2m_first", "t2m_second", "dif_pct")
    return rounded(rows, 4, "ventas_verano", "ventas_lluvioso")


@check("a13_company_month_means", f"""
WITH {st.WIDE}
SELECT empresa, mes, round(avg(t2m), 6) AS t2m FROM base
WHERE empresa IN ('NATION_1', 'NATION_2', 'NATION_7', 'NATION_9') GROUP BY empresa, mes
""")
def company_means(spark, sf):
    names = ["NATION_1", "NATION_2", "NATION_7", "NATION_9"]
    return rounded(reports.company_month_means(base(spark, sf), names, "t2m"), 6, "t2m")


@check("a14_monthly_series", f"""
WITH {st.WIDE}
SELECT ano, mes, empresa, round(sum(ventas), 2) AS ventas, make_date(ano, mes, 1) AS fecha
FROM base GROUP BY ano, mes, empresa
""")
def monthly_series(spark, sf):
    return rounded(reports.monthly_series(base(spark, sf)), 2, "ventas")


@check("a14_monthly_temperature", f"""
WITH {st.WIDE}
SELECT ano, mes, empresa, round(avg(t2m), 6) AS t2m, make_date(ano, mes, 1) AS fecha
FROM base GROUP BY ano, mes, empresa
""")
def monthly_temperature(spark, sf):
    return rounded(reports.monthly_temperature(base(spark, sf)), 6, "t2m")


@check("a15_seasonality", f"""
WITH {st.WIDE}, m AS (SELECT mes, avg(ventas) AS v FROM base GROUP BY mes)
SELECT mes, round(v, 4) AS ventas, round((SELECT avg(v) FROM m), 4) AS promedio_global FROM m
""")
def seasonality(spark, sf):
    return rounded(reports.seasonality(base(spark, sf)), 4, "ventas", "promedio_global")


@check("a20_trend", f"""
WITH {st.WIDE}
SELECT round(regr_slope(ventas / 1e6, t2m), 10) AS slope,
  round(regr_intercept(ventas / 1e6, t2m), 10) AS intercept, round(corr(t2m, ventas / 1e6), 8) AS corr,
  count(*) AS n, min(t2m) AS x_min, max(t2m) AS x_max
FROM base WHERE tarifa = 'BUILDING' AND t2m IS NOT NULL
""")
def trend(spark, sf):
    rows = reports.temperature_trend(base(spark, sf), "BUILDING")
    return rounded(rounded(rows, 10, "slope", "intercept"), 8, "corr")


@check("a20_trend_points", f"""
WITH {st.WIDE}, l AS (
  SELECT regr_slope(ventas / 1e6, rh2m) AS s, regr_intercept(ventas / 1e6, rh2m) AS i,
    min(rh2m) AS lo, max(rh2m) AS hi FROM base WHERE t2m IS NOT NULL
)
SELECT CAST(p.point AS INTEGER) AS point, round(lo + p.point * (hi - lo) / 99, 8) AS x,
  round(s * (lo + p.point * (hi - lo) / 99) + i, 8) AS y
FROM l CROSS JOIN range(0, 100) p(point)
""")
def trend_points(spark, sf):
    rows = reports.climate_trend_points(base(spark, sf), "rh2m", ["rh2m", "t2m"])
    return rounded(rows, 8, "x", "y")


@check("a21_correlation", f"""
WITH {st.WIDE}
SELECT empresa, round(corr(ws10m, ventas), 8) AS corr FROM base GROUP BY empresa
""")
def correlation(spark, sf):
    rows = base(spark, sf).groupBy("empresa").agg(F.corr("ws10m", "ventas").alias("corr"))
    return rounded(rows, 8, "corr")


@check("a24_company_summary", f"""
WITH {st.WIDE}
SELECT empresa, count(ventas) AS registros, round(sum(ventas) / 1e6, 1) AS ventas_total_m,
  round(avg(ventas) / 1e6, 2) AS ventas_prom_m, round(sum(ingreso_con_cvg) / 1e9, 1) AS ingreso_total_b,
  round(avg(precio_medio_con_cvg), 2) AS precio_medio, round(avg(t2m), 2) AS temp_prom,
  round(avg(prectotcorr), 2) AS lluvia_prom
FROM base GROUP BY empresa
""")
def company_summary(spark, sf):
    return reports.company_summary(base(spark, sf))


@check("a30_top_tariff_prices", f"""
WITH {st.WIDE}, top AS (SELECT tarifa FROM base GROUP BY tarifa ORDER BY sum(ventas) DESC, tarifa LIMIT 3)
SELECT ano, tarifa, round(avg(precio_medio_con_cvg), 6) AS precio_medio_con_cvg
FROM base WHERE tarifa IN (SELECT tarifa FROM top) GROUP BY ano, tarifa
""")
def top_tariffs(spark, sf):
    return rounded(reports.top_tariff_prices(base(spark, sf), 3), 6, "precio_medio_con_cvg")


TOP = """
s AS (SELECT empresa, sum(ventas) AS v FROM base GROUP BY empresa),
r AS (SELECT *, row_number() OVER (ORDER BY v DESC, empresa) AS rn FROM s),
t AS (SELECT CASE WHEN rn <= 5 THEN empresa ELSE 'Otros' END AS empresa, sum(v) AS ventas FROM r GROUP BY ALL)
"""


@check("t2_top5_other", f"WITH {st.WIDE}, {TOP} SELECT empresa, round(ventas, 2) AS ventas FROM t")
def top5(spark, sf):
    return rounded(aggregate.top_and_others(base(spark, sf), "empresa", "ventas"), 2, "ventas")


@check("a31_market_share", f"""
WITH {st.WIDE}, {TOP}
SELECT empresa, round(ventas, 2) AS ventas, round(ventas * 100 / (SELECT sum(ventas) FROM t), 6) AS share_pct
FROM t
""")
def market_share(spark, sf):
    rows = reports.market_share(base(spark, sf))
    return rounded(rounded(rows, 2, "ventas"), 6, "share_pct")


@check("t3_largest_customers", """
SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders
GROUP BY o_custkey ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 5
""")
def largest(spark, sf):
    sums = st.table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    return rounded(aggregate.top_rows(sums, "total", "o_custkey", 5), 2, "total")


@check("t5_ordered_rows", """
SELECT p_partkey, p_brand, p_retailprice FROM part ORDER BY p_brand, p_retailprice DESC, p_partkey
""")
def ordered(spark, sf):
    rows = st.table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return rows.orderBy("p_brand", F.col("p_retailprice").desc(), "p_partkey")


@check("t7_choices", f"WITH {st.WIDE} SELECT DISTINCT ano FROM base")
def choices(spark, sf):
    return reports.choices(base(spark, sf), "ano")


# ---- joins and sets -----------------------------------------------------------------

@check("j1_wide_left_join", f"""
WITH {st.PRICES}, {st.CLIMATE}
SELECT p.empresa, p.tarifa, p.sistema, p.ano, p.mes, p.ventas, c.t2m, c.ws10m, c.ps
FROM stg_prices p LEFT JOIN stg_climate c USING (empresa, ano, mes)
""")
def wide_join(spark, sf):
    prices = recipes.clean_prices(st.prices_raw(spark, sf))
    climate = clean_climate_keys(st.climate_raw(spark, sf))
    return recipes.wide_table(prices, climate).select(
        F.col("Empresa").alias("empresa"), F.col("Tarifa").alias("tarifa"),
        F.col("Sistema").alias("sistema"), F.col("Año").alias("ano"), F.col("Mes").alias("mes"),
        F.col("Ventas").alias("ventas"), F.col("T2M").alias("t2m"), F.col("WS10M").alias("ws10m"),
        F.col("PS").alias("ps"),
    )


@check("j6_normalised_join", f"""
WITH {st.ZONES}
SELECT c_custkey, count(*) AS pares FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN zones ON zones.id_objecto = c_custkey AND upper(trim(zones.operador)) = upper(trim(nation.n_name))
GROUP BY c_custkey
""")
def normalised_join(spark, sf):
    zones = st.zones_raw(spark, sf).select(
        F.col("id_Objecto").alias("c_custkey"), F.upper(F.trim("operador")).alias("name")
    )
    named = st.table(spark, sf, "customer").join(
        st.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.upper(F.trim("n_name")).alias("name"))
    return named.join(zones, ["c_custkey", "name"]).groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("pares")
    )


@check("j7_insert_absent", """
SELECT DISTINCT o_custkey, o_orderpriority FROM orders
WHERE (o_custkey, o_orderpriority) NOT IN (
  SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
""")
def insert_absent(spark, sf):
    orders = st.table(spark, sf, "orders")
    target = orders.filter("o_orderdate < timestamp_ntz '1998-01-01'")
    rows = orders.select("o_custkey", "o_orderpriority").distinct()
    return absent_rows(rows, target, ["o_custkey", "o_orderpriority"])


@check("h1_union_dates", """
SELECT CAST(o_orderdate AS DATE) AS fecha FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
UNION SELECT CAST(ts AS DATE) FROM events
""")
def union_dates(spark, sf):
    sources = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    dates = [st.table(spark, sf, t).select(F.to_date(c).alias("fecha")) for t, c in sources]
    return stack_by_name(dates).distinct()


@check("h3_union_padded", """
SELECT DISTINCT 'C' || c_mktsegment AS nk, c_mktsegment AS segmento, CAST(NULL AS VARCHAR) AS marca FROM customer
UNION SELECT 'P' || p_brand, CAST(NULL AS VARCHAR), p_brand FROM part
""")
def union_padded(spark, sf):
    segments = st.table(spark, sf, "customer").select(
        F.concat(F.lit("C"), "c_mktsegment").alias("nk"), F.col("c_mktsegment").alias("segmento")
    )
    brands = st.table(spark, sf, "part").select(
        F.concat(F.lit("P"), "p_brand").alias("nk"), F.col("p_brand").alias("marca")
    )
    return stack_by_name([segments, brands]).distinct()


@check("h4_stack_by_name", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
""")
def stacked(spark, sf):
    customers = st.table(spark, sf, "customer").select(
        "c_mktsegment", F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    suppliers = st.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return stack_by_name([customers, suppliers])


@check("h5_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def distinct(spark, sf):
    return st.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity").distinct()
