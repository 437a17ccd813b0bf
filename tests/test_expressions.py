import datetime
import math

import numpy as np
import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.functions import dates, numbers, text
from energy_mart.operators import filters, project


def values(spark, data, kind, expression):
    df = frame(spark, f"i int, c {kind}", *[(i, v) for i, v in enumerate(data)])
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_month_numbers(spark):
    names = ["ENERO", " febrero", "Setiembre", "SEPTIEMBRE\n", "", "MARCH", None]
    assert values(spark, names, "string", text.month_number) == [1, 2, 9, 9, None, None, None]


def test_month_names_cover_the_year(spark):
    names = values(spark, list(range(0, 14)), "int", text.month_name)
    assert names[0] is None and names[13] is None
    assert names[1] == "Enero" and names[9] == "Septiembre" and None not in names[1:13]


def test_boolean_words(spark):
    words = ["true", " T ", "1", "si", "SÍ", "yes", "Y", "false", "f", "0", "No", "n", "", "  ", "quizas", None]
    expected = [True] * 7 + [False] * 5 + [None] * 4
    assert values(spark, words, "string", text.boolean_text) == expected
    bad = values(spark, words, "string", text.is_bad_boolean)
    assert [w for w, b in zip(words, bad) if b] == ["quizas"]


def test_boolean_model_agrees_with_the_expression(spark):
    words = [(w,) for w in ["Sí", " no ", "x", "", None, "1"]]
    df = frame(spark, "rige string", *words)
    model = project.to_model(df, [f for f in schemas.FUELS if f.name == "rige"])
    assert rows(model) == [(True,), (False,), (None,), (None,), (None,), (True,)]


def test_lenient_numbers(spark):
    data = ["12.5", " 7 ", "\t3\n", "n/d", "", "NaN", "1e3", None]
    expected = [12.5, 7.0, 3.0, None, None, None, 1000.0, None]
    assert values(spark, data, "string", numbers.lenient_double) == expected
    assert values(spark, ["2020.0", "2020", "x", None, "99999999999"], "string", numbers.lenient_int) == [
        2020, 2020, None, None, None,
    ]


def test_strict_and_lenient_conversions(spark):
    df = frame(spark, "c string", ("x",))
    assert rows(project.convert(df, ["c"], "INT")) == [(None,)]
    assert rows(project.convert(df, ["c"], "datetime")) == [(None,)]
    assert rows(project.convert(df, ["c"], "unknown")) == [("x",)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        project.convert(df, ["c"], "float").collect()


def test_sentinel_and_zero_swaps(spark):
    df = frame(spark, "a double, b int, s string", (-999.0, 0, "0"), (1.0, None, None))
    assert rows(project.clear_sentinel(df, ["a"])) == [(None, 0, "0"), (1.0, None, None)]
    assert rows(project.swap_zero_null(df)) == [(-999.0, None, "0"), (1.0, None, None)]
    assert rows(project.swap_zero_null(df, to_zero=True)) == [(-999.0, 0, "0"), (1.0, 0, None)]


def test_tokens(spark):
    texts = ["a  b\tc", "solo", "   ", "", None]
    df = frame(spark, "i int, t string", *enumerate(texts))
    first = project.split_token(df, "t", 0, "head", "rest", drop=False).orderBy("i")
    assert [tuple(r)[2:] for r in first.collect()] == [
        ("a", "b c"), ("solo", None), (None, None), (None, None), (None, None),
    ]
    last = project.split_token(df, "t", -1, "tail", "rest").orderBy("i")
    assert "t" not in last.columns
    assert [tuple(r)[1:] for r in last.collect()][:2] == [("c", "a b"), ("solo", None)]
    outside = project.split_token(df, "t", 5, "none", "all").orderBy("i")
    assert [tuple(r)[1:] for r in outside.collect()][:2] == [(None, "a b c"), (None, "solo")]
    below = project.split_token(df, "t", -3, "third", "rest").orderBy("i")
    assert [tuple(r)[1:] for r in below.collect()][:2] == [("a", "b c"), (None, "solo")]
    with pytest.raises(ValueError):
        project.split_token(df, "missing")


def test_natural_key_keeps_places(spark):
    df = frame(spark, "a string, b string", (None, "x"), ("", None))
    key = text.natural_key(F.col("a"), F.col("b"), prefix="MEDIOS")
    assert rows(df.select(key)) == [("MEDIOS||x",), ("MEDIOS||",)]


def test_geometry_class(spark):
    wkt = ["POLYGON((1 1", "multipolygon (((", "Point (1 1)", "LINESTRING(", "CIRCLE", "", None]
    assert values(spark, wkt, "string", text.geometry_class) == [
        "POLYGON", "MULTIPOLYGON", "POINT", "LINESTRING", "DESCONOCIDO", "DESCONOCIDO", "DESCONOCIDO",
    ]


def test_periods_seasons_and_dates(spark):
    assert values(spark, [2020, 2023, 2025, None], "int", dates.period_label) == [
        "Pandemia (2020-2021)", "Recuperacion (2022-2023)", "Expansion (2024-2025)", "Expansion (2024-2025)",
    ]
    assert values(spark, [12, 4, 5, None], "int", dates.season_label) == [
        dates.SUMMER, dates.SUMMER, dates.RAINY, dates.RAINY,
    ]
    df = frame(spark, "y int, m int", (2020, 2), (2020, 13), (2020, 0), (None, 1))
    found = rows(df.select(dates.month_date(F.col("y"), F.col("m"))))
    assert found == [(datetime.date(2020, 2, 1),), (None,), (None,), (None,)]
    assert values(spark, ["202003", "202013"], "string", dates.yyyymm_date) == [
        datetime.date(2020, 3, 1), None,
    ]


def test_date_columns_ignore_a_missing_name(spark):
    df = frame(spark, "d string", ("2020-05-06",), ("bad",))
    assert [tuple(r)[1:] for r in project.add_date_parts(df, "d").collect()] == [(2020, 5), (None, None)]
    assert project.add_date_parts(df, "other") is df


def _forward(lon, lat):
    """Series of the forward projection, written for the test only."""
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, lam = math.radians(lat), math.radians(lon + 84.0)
    n = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    t, c, aa = math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2, lam * math.cos(phi)
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi)
        - (35 * e2**3 / 3072) * math.sin(6 * phi)
    )
    x = n * (
        aa + (1 - t + c) * aa**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * aa**5 / 120
    )
    y = m + n * math.tan(phi) * (
        aa**2 / 2
        + (5 - t + 9 * c + 4 * c**2) * aa**4 / 24
        + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * aa**6 / 720
    )
    return 0.9999 * x + 500000.0, 0.9999 * y


def test_reprojection_round_trip(spark):
    points = [(lon, lat) for lon in np.linspace(-86, -82.5, 8) for lat in np.linspace(8, 11.3, 8)]
    points.append((-84.0, 9.9))
    data = [(float(lon), float(lat), *_forward(lon, lat)) for lon, lat in points]
    df = frame(spark, "lon double, lat double, coordenadaX double, coordenadaY double", *data)
    for lon, lat, x, y in rows(project.reproject(df, lat="coordenadaY", lon="coordenadaX")):
        assert abs(lon - x) < 1e-8 and abs(lat - y) < 1e-8


def test_reprojection_of_one_column_and_bad_input(spark):
    df = frame(spark, "coordenadaX string, coordenadaY string", ("500000", "1000000"), ("x", None))
    one = project.reproject(df, lat="coordenadaY")
    assert one.columns == ["coordenadaX", "coordenadaY"]
    first, second = rows(one)
    assert first[0] == "500000" and 9 < first[1] < 9.1 and second == ("x", None)
    assert project.reproject(df) is df
    with pytest.raises(ValueError):
        project.reproject(df.drop("coordenadaX"), lat="coordenadaY")


def test_projection_guards(spark):
    df = frame(spark, "a int, b string, c boolean", (1, "x", True))
    assert project.keep_existing(df, ["c", "zz", "a"]).columns == ["c", "a"]
    assert project.numeric_columns(df) == ["a"]
    assert project.numeric_columns(df, reverse=True) == ["b", "c"]
    with pytest.raises(ValueError):
        project.drop_columns(df, ["zz"])
    twice = df.select("a", F.lit(1).alias("a"), "b")
    assert project.duplicate_names(twice) == {"a": 2}


def test_models_round_trip_names(spark):
    df = frame(spark, "`Año` string, Mes string", ("2020", "1"))
    model = project.to_model(df, schemas.PRICES)
    assert model.columns == [f.name for f in schemas.PRICES]
    assert model.first()["ano"] == 2020 and model.first()["tarifa"] is None
    assert project.to_source_names(model, schemas.PRICES).columns == schemas.layout(schemas.PRICES)


def test_range_and_total_filters(spark):
    df = frame(spark, "e string, v int", ("A", 1), ("TOTAL NACIONAL", 5), (None, 3), ("B", 10))
    assert rows(filters.without_total(df, "e")) == [("A", 1), ("B", 10)]
    assert rows(filters.outside_range(df, "v", 1, 10)) == [("A", 1), ("B", 10)]
    assert filters.chosen(df, e=None).count() == 4


def test_year_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    frame(spark, "d date", (datetime.date(2020, 1, 1),), (datetime.date(2021, 5, 1),)).write.parquet(path)
    out = filters.by_date_parts(spark.read.parquet(path), "d", year=2021, month=5)
    assert rows(out) == [(datetime.date(2021, 5, 1),)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2021-01-01)" in plan
