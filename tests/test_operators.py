import numpy as np
import pandas as pd
import pytest
from helpers import bag, frame, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from energy_mart.functions.numbers import lenient_int
from energy_mart.operators import aggregate, merge, numbering, profile, quality, quantiles
from energy_mart.plans import reports
from energy_mart.schemas import Field


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.floats(-1e6, 1e6), st.integers(-3, 3).map(float)),
        ),
        min_size=1, max_size=60,
    )
)
def test_ranked_quantiles_are_exact(spark, data):
    df = frame(spark, "g string, x double", *data)
    probs = (0.1, 0.25, 0.5, 0.75)
    found = {r["g"]: r["q"] for r in quantiles.exact_quantiles(df, ["x"], probs, ["g"]).collect()}
    for group in {g for g, _ in data}:
        x = [v for g, v in data if g == group and v is not None]
        if x:
            np.testing.assert_allclose(found[group], np.quantile(x, probs), rtol=1e-9, atol=1e-9)


def test_ranked_quantiles_with_one_hot_value(spark):
    hot = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.lit(7.0)).otherwise(F.col("id") * 1.0).alias("x"))
    expected = np.quantile(hot.toPandas()["x"], [0.25, 0.5, 0.75])
    q = quantiles.exact_quantiles(hot, ["x"], (0.25, 0.5, 0.75)).first()["q"]
    np.testing.assert_allclose(q, expected)


def test_missed_brackets_are_widened(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    wrong = quantiles.first_scan(df, ["x"], (0.9,), margin=0.0)
    q = quantiles.exact_quantiles(df, ["x"], (0.5,), first=wrong).first()["q"]
    assert q == [499.5]


def test_every_value_kept_as_the_last_try(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    wrong = quantiles.first_scan(df, ["x"], (0.9,), margin=0.0)
    monkeypatch.setattr(quantiles, "first_scan", lambda *a, **k: wrong)
    q = quantiles.exact_quantiles(df, ["x"], (0.5,)).first()["q"]
    assert q == [499.5]


def test_dense_numbers_and_running_totals(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("k"))
    numbered = numbering.dense_numbers(df, ["k"], "n", start=5)
    assert [tuple(r) for r in numbered.orderBy("k").collect()] == [(k, k + 6) for k in range(1000)]
    grouped = df.withColumn("g", F.when(F.col("k") < 900, "hot").otherwise(F.lit(None)))
    totals = numbering.running_total(grouped, ["k"], "k", "upto", by=["g"]).toPandas()
    for _, part in totals.groupby("g", dropna=False):
        part = part.sort_values("k")
        assert (part["k"].cumsum() == part["upto"]).all()


def test_numbers_of_an_empty_frame(spark):
    assert numbering.dense_numbers(frame(spark, "k int"), ["k"], "n").count() == 0


def test_metrics_and_nulls(spark):
    df = frame(
        spark, "a double, b boolean, s string, z int",
        (float("nan"), False, "0", None), (0.0, True, None, None), (2.0, None, "x", None),
    )
    assert rows(profile.dataset_metrics(df)) == [(3, 4, pytest.approx(600 / 12), 2)]
    assert bag(profile.null_counts(df)) == [("a", 1, 3), ("b", 1, 3), ("s", 1, 3), ("z", 3, 3)]
    assert profile.complete_columns(df) == []
    assert bag(profile.zero_counts(df, by_column=True)) == [("a", 1), ("b", 1), ("s", 0), ("z", 0)]
    empty = frame(spark, "a int")
    assert rows(profile.dataset_metrics(empty)) == [(0, 1, None, 0)]


def test_keep_complete_follows_the_data(spark):
    df = frame(spark, "a int, b int, c int", (1, None, 3), (2, 2, 4))
    assert profile.keep_complete(df, ["c", "b", "zz", "a"]).columns == ["c", "a"]


def test_duplicates_keep_all_copies_with_nulls(spark):
    df = frame(spark, "a int, b string", (1, None), (1, None), (2, "x"), (1, None))
    assert rows(profile.duplicated_rows(df)) == [(1, None)] * 3


def test_distinct_counts_ignore_null_but_list_it(spark):
    df = frame(spark, "a string", ("x",), (None,), ("x",))
    assert rows(profile.distinct_counts(df, ["a"])) == [("a", 1)]
    assert bag(profile.distinct_values(df, ["a"])) == [("a", "x", 2), ("a", None, 1)]


def test_value_classes_follow_the_first_row(spark):
    df = frame(
        spark, "i int, v string",
        (0, None), (1, "12"), (2, "1.5"), (3, "2020-01-01"), (4, "true"), (5, "x"), (6, "7"),
    )
    odd = profile.inconsistent_rows(df, ["v"], "i").orderBy("i")
    assert [(r["i"], r["class"], r["base_class"]) for r in odd.collect()] == [
        (2, "decimal", "int"), (3, "date", "int"), (4, "bool", "int"), (5, "text", "int"),
    ]


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [3.0, 1.0, None, 10.0, 4.0], "y": [1.0, 2.0, 3.0, 4.0, 5.0]})
    df = frame(spark, "x double, y double", *[(None if pd.isna(a) else a, b) for a, b in pdf.values.tolist()])
    expected = pdf.describe()
    for r in profile.describe(df, ["x", "y"]).collect():
        found = [r[k] for k in ("n", "mean", "std", "min", "q25", "q50", "q75", "max")]
        np.testing.assert_allclose(found, expected[r["column"]].tolist())


def test_correlations_pairwise_and_listwise(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, 9], "b": [2.0, None, 1, 7, 5], "c": [5.0, 4, None, 2, 8]})
    clean = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.values.tolist()]
    df = frame(spark, "a double, b double, c double", *clean)
    for listwise, expected in ((False, pdf.corr()), (True, pdf.dropna().corr())):
        for r in profile.correlations(df, listwise=listwise).collect():
            assert r["corr"] == pytest.approx(expected.loc[r["a"], r["b"]])


def test_outliers_and_box(spark):
    data = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -50.0]
    df = frame(spark, "x double", *[(v,) for v in data])
    q1, q3 = np.quantile(data, [0.25, 0.75])
    outside = sorted(v for v in data if v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1))
    assert sorted(r["value"] for r in profile.outlier_rows(df, ["x"]).collect()) == outside
    box = profile.box_figures(df, ["x"]).first()
    assert (box["whisker_low"], box["whisker_high"], box["fliers"]) == (1.0, 5.0, 2)


def test_histogram_keeps_the_maximum(spark):
    df = frame(spark, "x double", *[(float(v),) for v in range(31)])
    bins = profile.histogram(df, "x").orderBy("bin").collect()
    assert len(bins) == 30 and [b["n"] for b in bins] == list(np.histogram(range(31), 30)[0])
    assert profile.histogram(frame(spark, "x double", (None,)), "x").count() == 0
    assert sum(r["n"] for r in profile.histogram(frame(spark, "x int", (3,), (3,)), "x").collect()) == 2


def test_reconciliation_needs_both_sides(spark):
    df = frame(
        spark, "m int, e string, v double",
        (1, "T", 100.0), (1, "A", 60.0), (1, "B", 30.0), (2, "A", 5.0), (3, "T", 7.0), (1, "A", None),
    )
    out = aggregate.reconcile_totals(df, F.col("e") == "T", "v", ["m"])
    assert rows(out) == [(1, 90.0, 100.0, 10.0, 0.0, 10.0)]


def test_top_and_others_and_shares(spark):
    df = frame(spark, "k string, v double", *[(c, float(i)) for i, c in enumerate("abcdefg")], (None, 99.0))
    top = aggregate.top_and_others(df, "k", "v", 2)
    assert bag(top) == [("Otros", 10.0), ("f", 5.0), ("g", 6.0)]
    shares = {r["k"]: r["share_pct"] for r in aggregate.share_of_total(top, "v").collect()}
    assert sum(shares.values()) == pytest.approx(100) and shares["g"] == pytest.approx(600 / 21)


def test_mean_of_means_is_not_the_mean(spark):
    df = frame(spark, "k string, v double", ("a", 1.0), ("a", 3.0), ("b", 10.0))
    assert rows(aggregate.mean_of_means(df, "k", "v")) == [(6.0,)]


def test_month_matrix_keeps_missing_months(spark):
    df = frame(spark, "e string, mes int, v double", ("a", 1, 2.0), ("a", 1, 4.0), ("b", 12, 1.0))
    out = aggregate.month_matrix(df, "e", "v").orderBy("e")
    assert out.columns == ["e", *aggregate.MONTH_LABELS]
    assert [(r["Ene"], r["Feb"], r["Dic"]) for r in out.collect()] == [(3.0, None, None), (None, None, 1.0)]


def test_trend_matches_polyfit(spark):
    x, y = [1.0, 2.0, 4.0, 7.0], [2.0, 1.0, 5.0, 9.0]
    df = frame(spark, "x double, y double", *zip(x, y), (None, 3.0), (4.0, None))
    slope, intercept = np.polyfit(x, y, 1)
    line = aggregate.linear_trend(df, "x", "y").first()
    assert (line["slope"], line["intercept"]) == (pytest.approx(slope), pytest.approx(intercept))
    points = aggregate.trend_points(df, "x", "y").orderBy("point").collect()
    np.testing.assert_allclose([p["y"] for p in points], np.polyval([slope, intercept], np.linspace(1, 7, 100)))


def test_empty_base_gives_null_change(spark):
    df = frame(spark, "k string, v double", ("a", 0.0), ("b", 5.0))
    out = aggregate.compare_slices(df, "v", F.col("k") == "a", F.col("k") == "b").first()
    assert out["change_pct"] is None


def test_columns_and_groups_without_values_keep_null_rows(spark):
    df = frame(spark, "g string, x double, y double", ("a", 1.0, None), ("a", 3.0, None), ("b", None, None))
    cuts = quantiles.exact_quantiles(df, ["x", "y"], (0.5,), ["g"])
    assert bag(cuts) == sorted([("a", "x", [2.0]), ("a", "y", None), ("b", "x", None), ("b", "y", None)], key=repr)
    assert profile.outlier_rows(df, ["x", "y"]).count() == 0
    found = {r["column"]: r for r in profile.box_figures(df, ["x", "y"]).collect()}
    assert (found["y"]["q1"], found["y"]["fliers"]) == (None, 0) and found["x"]["whisker_high"] == 3.0
    assert {r["column"]: r["outliers"] for r in profile.outlier_summary(df, ["x", "y"]).collect()} == {"x": 0, "y": 0}
    assert profile.describe(df, ["y"]).first()["q50"] is None


def test_matrix_headers_have_no_limit(spark):
    df = spark.range(3000).selectExpr("'c' nombre_empresa", "cast(id as string) bloque_consumo", "1.0D ventas_total")
    assert reports.block_sales(df).count() == 3000
    assert reports.block_matrix(df, ["5", "7"]).columns == ["nombre_empresa", "5", "7"]


def test_nan_is_no_distinct_value_and_names_may_have_dots(spark):
    df = frame(spark, "`a.b` double", (float("nan"),), (1.0,), (2.0,), (2.0,), (None,))
    assert profile.distinct_counts(df, ["a.b"]).first()["distinct"] == 2
    assert profile.duplicated_rows(df).count() == 2
    assert quantiles.exact_quantiles(df, ["a.b"], (0.5,)).first()["q"] == [2.0]
    assert merge.first_by(df.withColumn("k.k", F.lit(1)), ["k.k"]).count() == 1


def test_fractions_are_no_whole_numbers(spark):
    df = frame(spark, "v string", ("2020.0",), ("2020.7",), ("-1.5",), ("x",))
    whole = [r[0] for r in df.select(lenient_int(F.col("v"))).collect()]
    assert whole == [2020, None, None, None]
    rules = quality.source_rules(df, [Field("v", "v", "int")])
    assert quality.split_rejects(df, rules)[1].count() == 3


def test_first_by_is_deterministic(spark):
    df = frame(spark, "k int, a string, b int", (1, "z", 1), (1, None, 9), (2, "x", 2), (1, None, 3))
    assert bag(merge.first_by(df, ["k"])) == [(1, None, 3), (2, "x", 2)]
    assert bag(merge.first_by(df.repartition(3), ["k"])) == [(1, None, 3), (2, "x", 2)]


def test_upsert_lets_a_null_win(spark):
    target = frame(spark, "key int, id int, a string, t string", (1, 10, "old", "t0"), (2, 20, "keep", "t0"))
    source = frame(spark, "id int, a string", (10, None), (30, "new"))
    out = merge.upsert(target, source, ["id"], kept=["key"], stamp=("t", F.lit("t1")))
    assert bag(out) == [(1, 10, None, "t1"), (2, 20, "keep", "t0"), (None, 30, "new", "t1")]


def test_reject_split(spark):
    model = (Field("n", "n", "int"), Field("f", "f", "boolean"), Field("s", "s", "string", 3))
    df = frame(spark, "n string, f string, s string", ("1", "si", "abc"), ("x", "tal vez", "abcd"), (None, "", None))
    rules = quality.source_rules(df, model)
    good, bad = quality.split_rejects(df, rules)
    assert bag(good) == [("1", "si", "abc"), (None, "", None)]
    assert bad.first()[quality.REASONS] == ["n is not int", "f is not a boolean", "s longer than 3"]
    assert rows(quality.load_summary(df, rules, "t")) == [("t", 3, 2, 1)]
    with pytest.raises(ValueError):
        quality.check_frame("not a frame")


def test_constraint_checks(spark):
    fact = frame(spark, "k int, v int", (1, 1), (1, 2), (3, 1), (None, 0))
    dim = frame(spark, "key int", (1,))
    assert rows(quality.repeated_grain(fact, ["k"])) == [(1, 2)]
    assert rows(quality.orphan_rows(fact, "k", dim, "key")) == [(3, 1)]
    assert rows(quality.lookup_losses(fact, dim, {"k": "key"})) == [(2,)]
    assert bag(quality.missing_values(fact, ["k", "v"])) == [("k", 1), ("v", 0)]


def test_repeated_keys_keep_the_first(spark):
    df = frame(spark, "i int, k int", (1, 7), (2, 7), (3, None), (4, None), (5, 8))
    kept, later = quality.split_repeated(df, ["k"], "i")
    assert bag(kept.select("i", "k")) == [(1, 7), (3, None), (5, 8)]
    assert sorted(r["i"] for r in later.collect()) == [2, 4]
    assert later.first()[quality.REASONS] == ["repeated k"]
