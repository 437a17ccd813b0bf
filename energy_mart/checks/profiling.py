"""Profiling and quality checks."""

from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.checks import standins as st
from energy_mart.checks.registry import check
from energy_mart.operators import profile, project, quality
from energy_mart.plans import reports, star

MEASURES = ("ventas", "precio_medio_con_cvg", "t2m", "prectotcorr")


def base(spark, sf):
    return reports.base(st.wide(spark, sf), st.PERIODS, st.LAST_PERIOD)


def rounded(df, decimals, *names):
    return df.withColumns({n: F.round(n, decimals) for n in names})


def documents_with_labels(spark, sf):
    return st.table(spark, sf, "documents").join(st.table(spark, sf, "labels"), "doc_id", "left")


@check("q1_dataset_metrics", f"""
WITH {st.WIDE}
SELECT count(*) AS rows, CAST(6 AS INTEGER) AS columns,
  round((count(*) FILTER (WHERE abonados IS NULL) + count(*) FILTER (WHERE t2m IS NULL)) * 100e0 / (count(*) * 6), 6) AS null_pct,
  CAST(count(*) FILTER (WHERE row_id = 0) + count(*) FILTER (WHERE ventas = 0) + count(*) FILTER (WHERE t2m = 0) + count(*) FILTER (WHERE abonados = 0)
    + count(*) FILTER (WHERE ws10m = 0) AS BIGINT) AS zeros
FROM base
""")
def metrics(spark, sf):
    rows = base(spark, sf).select("row_id", "empresa", "ventas", "t2m", "abonados", "ws10m")
    return rounded(profile.dataset_metrics(rows), 6, "null_pct")


@check("q2_null_counts", """
WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'quality' AS "column", count(*) FILTER (WHERE quality IS NULL) AS nulls, count(*) AS rows FROM d
UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL), count(*) FROM d
""")
def null_counts(spark, sf):
    return profile.null_counts(documents_with_labels(spark, sf))


@check("q3_null_shares", f"""
WITH {st.WIDE}, s AS (
  SELECT 'abonados' AS "column", count(*) FILTER (WHERE abonados IS NULL) AS nulls, count(*) AS n FROM base
  UNION ALL SELECT 't2m', count(*) FILTER (WHERE t2m IS NULL), count(*) FROM base
  UNION ALL SELECT 'prectotcorr', count(*) FILTER (WHERE prectotcorr IS NULL), count(*) FROM base)
SELECT "column", nulls, round(nulls * 100e0 / n, 6) AS null_pct, nulls * 100e0 / n > 25 AS over_threshold
FROM s
""")
def null_shares(spark, sf):
    return rounded(profile.null_shares(base(spark, sf), 25.0), 6, "null_pct")


@check("q4_keep_complete", """
SELECT text, lang, doc_id FROM documents
""")
def keep_complete(spark, sf):
    return profile.keep_complete(documents_with_labels(spark, sf), ["text", "quality", "lang", "doc_id"])


@check("q5_distinct_counts", f"""
WITH {st.WIDE}
SELECT 'empresa' AS "column", count(DISTINCT empresa) AS "distinct" FROM base
UNION ALL SELECT 'tarifa', count(DISTINCT tarifa) FROM base
UNION ALL SELECT 'abonados', count(DISTINCT abonados) FROM base
UNION ALL SELECT 'ventas', count(DISTINCT ventas) FROM base
""")
def distinct_counts(spark, sf):
    return profile.distinct_counts(base(spark, sf), ["empresa", "tarifa", "abonados", "ventas"])


@check("q5_distinct_values", """
SELECT 'lang' AS "column", lang AS value, count(*) AS n FROM documents GROUP BY lang
UNION ALL SELECT 'quality', CAST(quality AS VARCHAR), count(*)
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality
""")
def distinct_values(spark, sf):
    return profile.distinct_values(documents_with_labels(spark, sf), ["lang", "quality"])


MIXED = """
mixed AS (
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST(event_id AS VARCHAR)
    WHEN 1 THEN CAST(value AS VARCHAR) WHEN 2 THEN strftime(ts, '%Y-%m-%d')
    WHEN 3 THEN CASE WHEN event_id % 2 = 0 THEN 'True' END ELSE event_type END AS v,
    CASE event_id % 5 WHEN 0 THEN 'int' WHEN 1 THEN 'decimal' WHEN 2 THEN 'date'
    WHEN 3 THEN CASE WHEN event_id % 2 = 0 THEN 'bool' END ELSE 'text' END AS class
  FROM events
)
"""


def mixed(spark, sf):
    key = F.col("event_id")
    return st.table(spark, sf, "events").select(
        "event_id",
        F.when(key % 5 == 0, key.cast("string"))
        .when(key % 5 == 1, F.col("value").cast("string"))
        .when(key % 5 == 2, F.date_format("ts", "yyyy-MM-dd"))
        .when(key % 5 == 3, F.when(key % 2 == 0, "True"))
        .otherwise(F.col("event_type"))
        .alias("v"),
        F.col("event_type").alias("w"),
    )


@check("q6_value_classes", f"""
WITH {MIXED}
SELECT 'v' AS "column", 'int' AS base_class, CAST(0 AS BIGINT) AS base_at, class, count(*) AS n
FROM mixed WHERE class IS NOT NULL GROUP BY class
UNION ALL SELECT 'w', 'text', 0, 'text', count(*) FROM mixed
""")
def value_classes(spark, sf):
    return profile.value_classes(mixed(spark, sf), ["v", "w"], "event_id")


@check("q6_inconsistent_rows", f"""
WITH {MIXED}
SELECT 'v' AS "column", event_id, v AS value, class, 'int' AS base_class
FROM mixed WHERE class <> 'int'
""")
def inconsistent_rows(spark, sf):
    return profile.inconsistent_rows(mixed(spark, sf), ["v", "w"], "event_id")


@check("q7_zero_counts", """
SELECT 'l_discount' AS "column", count(*) FILTER (WHERE l_discount = 0) AS zeros FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE l_tax = 0) FROM lineitem
UNION ALL SELECT 'l_returnflag', 0
UNION ALL SELECT 'returned', count(*) FILTER (WHERE l_returnflag <> 'R') FROM lineitem
""")
def zero_counts(spark, sf):
    rows = st.table(spark, sf, "lineitem").select(
        "l_discount", "l_tax", "l_returnflag", (F.col("l_returnflag") == "R").alias("returned")
    )
    return profile.zero_counts(rows, by_column=True)


@check("q8_duplicated_rows", """
WITH d AS (SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_partkey % 40 AS p FROM lineitem)
SELECT * FROM d QUALIFY count(*) OVER (PARTITION BY l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, p) > 1
""")
def duplicated_rows(spark, sf):
    rows = st.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax",
        (F.col("l_partkey") % 40).alias("p"),
    )
    return profile.duplicated_rows(rows)


REJECTED = """
landed AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'n/d' ELSE CAST(o_custkey AS VARCHAR) END AS id_text,
    CASE WHEN o_orderkey % 13 = 0 THEN 'quizas' WHEN o_orderkey % 2 = 0 THEN 'si' ELSE '' END AS flag,
    c_name || CASE WHEN o_orderkey % 17 = 0 THEN repeat('x', 20) ELSE '' END AS operator
  FROM orders JOIN customer ON o_custkey = c_custkey
)
"""
LANDED_MODEL = (
    schemas.Field("idText", "id_text", "int"),
    schemas.Field("flagText", "flag", "boolean"),
    schemas.Field("operatorName", "operator", "string", 30),
)


def landed(spark, sf):
    key = F.col("o_orderkey")
    joined = st.table(spark, sf, "orders").join(
        st.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select(
        "o_orderkey",
        F.when(key % 11 == 0, "n/d").otherwise(F.col("o_custkey").cast("string")).alias("idText"),
        F.when(key % 13 == 0, "quizas").when(key % 2 == 0, "si").otherwise("").alias("flagText"),
        F.concat("c_name", F.when(key % 17 == 0, "x" * 20).otherwise("")).alias("operatorName"),
    )


@check("q10_reject_split", f"""
WITH {REJECTED}
SELECT o_orderkey, concat_ws('; ', CASE WHEN id_text = 'n/d' THEN 'id_text is not int' END,
  CASE WHEN flag = 'quizas' THEN 'flag is not a boolean' END,
  CASE WHEN length(operator) > 30 THEN 'operator longer than 30' END) AS reasons
FROM landed WHERE id_text = 'n/d' OR flag = 'quizas' OR length(operator) > 30
""")
def reject_split(spark, sf):
    rows = landed(spark, sf)
    _, rejected = quality.split_rejects(rows, quality.source_rules(rows, LANDED_MODEL))
    return rejected.select("o_orderkey", F.array_join(quality.REASONS, "; ").alias("reasons"))


@check("q10_accepted_rows", f"""
WITH {REJECTED}
SELECT CAST(id_text AS INTEGER) AS id_text, CASE WHEN flag = 'si' THEN true END AS flag, operator
FROM landed WHERE NOT (id_text = 'n/d' OR flag = 'quizas' OR length(operator) > 30)
""")
def accepted(spark, sf):
    rows = landed(spark, sf)
    good, _ = quality.split_rejects(rows, quality.source_rules(rows, LANDED_MODEL))
    return project.to_model(good, LANDED_MODEL)


@check("q10_load_summary", f"""
WITH {REJECTED}, b AS (SELECT id_text = 'n/d' OR flag = 'quizas' OR length(operator) > 30 AS bad FROM landed)
SELECT 'orders' AS "table", count(*) AS total, count(*) FILTER (WHERE NOT bad) AS accepted, count(*) FILTER (WHERE bad) AS rejected FROM b
""")
def summary(spark, sf):
    rows = landed(spark, sf)
    return quality.load_summary(rows, quality.source_rules(rows, LANDED_MODEL), "orders")


@check("q10_star_widths", f"""
WITH {st.PRICES}
SELECT DISTINCT tarifa AS nombre_tarifa, sistema, 'nombre_tarifa longer than 8' AS reasons
FROM stg_prices WHERE length(tarifa) > 8
""")
def star_widths(spark, sf):
    rows = star.tariff_rows(st.staging(spark, sf, ("stg_aresep_medios",)))
    marked = quality.with_reasons(rows, quality.length_rules({"nombre_tarifa": 8, "tarifa_nk": 500}))
    wide = marked.filter(F.size(quality.REASONS) > 0)
    return wide.select(
        "nombre_tarifa", "sistema", F.array_join(quality.REASONS, "; ").alias("reasons")
    )


@check("q11_repeated_grain", """
SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def repeated_grain(spark, sf):
    return quality.repeated_grain(st.table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@check("q12_orphan_rows", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
""")
def orphans(spark, sf):
    known = st.table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'")
    rows = st.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return quality.orphan_rows(rows, "o_custkey", known, "c_custkey")


@check("q13_missing_values", """
SELECT 'doc_id' AS "column", CAST(0 AS BIGINT) AS nulls
UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM documents LEFT JOIN labels USING (doc_id)
""")
def missing(spark, sf):
    return quality.missing_values(documents_with_labels(spark, sf), ["doc_id", "quality"])


@check("q13_lookup_losses", """
SELECT source, count(*) AS lost FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
GROUP BY source
""")
def losses(spark, sf):
    rows = st.table(spark, sf, "documents")
    return quality.lookup_losses(rows, st.table(spark, sf, "labels"), {"doc_id": "doc_id"}, ["source"])


# ---- statistics ---------------------------------------------------------------------

def _describe_sql(source, by, names, digits=6):
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {group}'{c}' AS "column", count({c}) AS n, round(avg({c}), {digits}) AS mean,
        round(stddev_samp({c}), {digits}) AS std, min({c}) AS min,
        round(quantile_cont({c}, 0.25), {digits}) AS q25, round(quantile_cont({c}, 0.5), {digits}) AS q50,
        round(quantile_cont({c}, 0.75), {digits}) AS q75, max({c}) AS max FROM {source}{tail}"""
        for c in names
    )


def _described(df, digits=6):
    return rounded(df, digits, "mean", "std", "q25", "q50", "q75")


DESCRIBE = f"WITH {st.WIDE} " + _describe_sql("base", "", MEASURES, 4)


@check("a16_describe", DESCRIBE)
def describe(spark, sf):
    return _described(profile.describe(base(spark, sf), MEASURES), 4)


@check("a16_describe_ranked", DESCRIBE)
def describe_ranked(spark, sf):
    """The same through the distributed quantiles used for large groups."""
    return _described(profile.describe(base(spark, sf), MEASURES), 4)


BY_TYPE = _describe_sql("events", "event_type", ("value",), 6)


@check("a16_describe_by_group", BY_TYPE)
def describe_by(spark, sf):
    return _described(profile.describe(st.table(spark, sf, "events"), ["value"], ["event_type"]))


@check("a16_describe_by_group_ranked", BY_TYPE)
def describe_by_ranked(spark, sf):
    rows = st.table(spark, sf, "events")
    return _described(profile.describe(rows, ["value"], ["event_type"]))


def _pairs(names, listwise=False):
    source = "base"
    if listwise:
        source = "(SELECT * FROM base WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in names) + ")"
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM {source}"
        for a in names
        for b in names
    )


CORRELATED = ("ventas", "precio_medio_con_cvg", "t2m", "prectotcorr", "t2m_max")


@check("a17_correlations_pairwise", f"WITH {st.WIDE} {_pairs(CORRELATED)}")
def pairwise(spark, sf):
    return rounded(profile.correlations(base(spark, sf), CORRELATED), 8, "corr")


@check("a18_correlations_listwise", f"WITH {st.WIDE} {_pairs(CORRELATED, True)}")
def listwise(spark, sf):
    return rounded(profile.correlations(base(spark, sf), CORRELATED, listwise=True), 8, "corr")


@check("a17_correlation_matrix", f"WITH {st.WIDE} " + " UNION ALL ".join(
    f"SELECT '{a}' AS \"column\", " + ", ".join(f"round(corr({a}, {b}), 8) AS {b}" for b in CORRELATED)
    + " FROM base" for a in CORRELATED))
def square(spark, sf):
    return rounded(profile.correlation_matrix(base(spark, sf), CORRELATED), 8, *CORRELATED)


COMPLETE = "FROM base WHERE t2m IS NOT NULL AND prectotcorr IS NOT NULL"
RANKED = ("t2m", "ws10m", "rh2m", "prectotcorr", "t2m_max")
AGAINST = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(corr(ventas, {c}), 8) AS corr {COMPLETE}""" for c in RANKED
)


@check("a18_correlation_ranking", f"WITH {st.WIDE} {AGAINST}")
def ranking(spark, sf):
    return rounded(reports.climate_correlations(base(spark, sf), RANKED), 8, "corr")


@check("a18_strongest", f"""
WITH {st.WIDE}, c AS ({AGAINST})
SELECT *, 'alta' AS side FROM (SELECT * FROM c ORDER BY corr DESC LIMIT 3)
UNION ALL SELECT *, 'baja' FROM (SELECT * FROM c ORDER BY corr LIMIT 3)
""")
def strongest(spark, sf):
    rows = rounded(reports.climate_correlations(base(spark, sf), RANKED), 8, "corr")
    return reports.strongest(rows)


BOUNDS = """
bounds AS (
  SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
    q1 - (q3 - q1) * 1.5 AS low, q3 + (q3 - q1) * 1.5 AS high FROM events GROUP BY event_type
)
"""
SUMMARY = f"""
WITH {BOUNDS}
SELECT event_type, 'value' AS "column", round(any_value(low), 6) AS low, round(any_value(high), 6) AS high,
  count(*) FILTER (WHERE value < low OR value > high) AS outliers
FROM events JOIN bounds USING (event_type) GROUP BY event_type
"""


@check("a19_outlier_summary", SUMMARY)
def outlier_summary(spark, sf):
    rows = st.table(spark, sf, "events")
    return rounded(profile.outlier_summary(rows, ["value"], ["event_type"]), 6, "low", "high")


@check("a19_outlier_summary_ranked", SUMMARY)
def outlier_summary_ranked(spark, sf):
    rows = st.table(spark, sf, "events")
    return rounded(profile.outlier_summary(rows, ["value"], ["event_type"]), 6, "low", "high")


@check("a19_outlier_rows", """
WITH b AS (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events
)
SELECT 'value' AS "column", value FROM events, b
WHERE value < q1 - (q3 - q1) * 1.5 OR value > q3 + (q3 - q1) * 1.5
""")
def outlier_rows(spark, sf):
    return profile.outlier_rows(st.table(spark, sf, "events"), ["value"])


@check("a28_box_figures", f"""
WITH {BOUNDS}
SELECT event_type, 'value' AS "column", round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3,
  min(value) FILTER (WHERE value BETWEEN low AND high) AS whisker_low,
  max(value) FILTER (WHERE value BETWEEN low AND high) AS whisker_high,
  count(*) FILTER (WHERE value NOT BETWEEN low AND high) AS fliers
FROM events JOIN bounds USING (event_type) GROUP BY event_type
""")
def box(spark, sf):
    rows = st.table(spark, sf, "events")
    return rounded(profile.box_figures(rows, ["value"], ["event_type"]), 6, "q1", "q3")


@check("a27_histogram", """
WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
c AS (
  SELECT CAST(least(floor((value - lo) / (hi - lo) * 30) + 1, 30) AS INTEGER) AS bin, count(*) AS n
  FROM events, e GROUP BY bin
)
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (b.bin - 1) * (hi - lo) / 30, 6) AS low,
  round(lo + b.bin * (hi - lo) / 30, 6) AS high, coalesce(n, 0) AS n
FROM range(1, 31) b(bin) CROSS JOIN e LEFT JOIN c ON c.bin = b.bin
""")
def histogram(spark, sf):
    return rounded(profile.histogram(st.table(spark, sf, "events"), "value"), 6, "low", "high")
