import pytest
from helpers import bag, frame, rows
from pyspark.sql import functions as F

from energy_mart import schemas, session
from energy_mart.operators import project
from energy_mart.plans import recipes
from energy_mart.sources import climate, files, tables


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_files_stack_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", "﻿Mes, Año,Empresa\nENERO,2020,A\n")
    write(tmp_path / "b.csv", 'Empresa,"Mes"\n"B, S.A.",FEBRERO\n')
    out = files.read_csv_files(spark, str(tmp_path / "*.csv"))
    assert bag(out.select("Mes", "Año", "Empresa")) == [("ENERO", "2020", "A"), ("FEBRERO", None, "B, S.A.")]
    with pytest.raises(FileNotFoundError):
        files.read_csv_files(spark, str(tmp_path / "*.none"))


def test_many_files_of_one_layout_are_one_scan(spark, tmp_path):
    for i in range(5):
        write(tmp_path / f"{i}.csv", f"a,b\n{i},x\n")
    out = files.read_csv_files(spark, str(tmp_path / "*.csv"))
    assert out.count() == 5
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_missing_words(spark, tmp_path):
    path = write(tmp_path / "n.csv", "a,b\nNA,x\nnull,NAN\n,n/a\n")
    assert rows(files.read_csv(spark, path)) == [(None, "x"), (None, "NAN"), (None, None)]
    assert rows(files.read_csv(spark, path, keep_na=True))[0] == ("NA", "x")


def test_latin1(spark, tmp_path):
    path = write(tmp_path / "l.csv", "año\nSÍ\n", "latin1")
    out = files.read_csv(spark, path, encoding="ISO-8859-1")
    assert out.columns == ["año"] and rows(out) == [("SÍ",)]


def test_required_columns(spark, tmp_path):
    path = write(tmp_path / "p.csv", "operador,coordenadaX\nx,1\n")
    with pytest.raises(ValueError, match="coordenadaY"):
        files.read_plants(spark, path)
    with pytest.raises(ValueError, match="area"):
        files.read_zones(spark, path)


def test_company_points_drop_unknown_and_repeated(spark):
    ice = "INSTITUTO COSTARRICENSE DE ELECTRICIDAD"
    plants = frame(
        spark, "operador string, coordenadaX string, coordenadaY string",
        (ice, "1", "2"), (f" {ice} ", "1", "2"), ("OTRA S.A.", "1", "2"), (ice, "x", "2"), (None, "1", "1"),
    )
    assert rows(files.company_points(plants)) == [("ICE", 2.0, 1.0)]
    assert rows(files.available_companies(files.company_points(plants))) == [("ICE",)]


def test_payload_clears_the_sentinel_before_the_mean(spark):
    def body(value):
        return (
            '{"properties":{"parameter":{"T2M":{"202001":%s,"202013":5.0},'
            '"WS10M":{"202001":1.0}}}}' % value
        )

    df = frame(spark, "empresa string, payload string", ("A", body("-999.0")), ("A", body("20.0")))
    out = climate.monthly_climate(df)
    assert out.columns[:3] == ["Empresa", "Año", "Mes"] and len(out.columns) == 18
    row = out.collect()
    assert len(row) == 1 and (row[0]["T2M"], row[0]["WS10M"], row[0]["PS"]) == (20.0, 1.0, None)


def test_climate_keys(spark):
    df = frame(spark, "` Empresa` string, `Año` string, Mes string", (" ice ", "2020.0", "1"), (None, "2020", "1"), ("x", "n", "1"))
    assert rows(climate.clean_climate_keys(df)) == [("ICE", 2020, 1)]


def test_catalogs_with_quoted_newlines(spark, tmp_path):
    header = "ID,Name,Tags,Services,Availability,Description,Keywords,Warnings_API_Original\n"
    row = 'x,X,"a,b",api,actual,"line one\nline ""two""","k,v",\n'
    for file, (_, columns) in schemas.CATALOGS.items():
        text = header + row if "Name" in columns else ",".join(columns) + "\n" + ",".join("v" * len(columns)) + "\n"
        write(tmp_path / file, text)
    root = str(tmp_path / "out")
    for _ in range(2):
        audit = tables.refresh_catalogs(spark, str(tmp_path), root)
        assert [r["rows"] for r in audit.collect()] == [1] * 6
    loaded = tables.catalog(spark, root, "catalogo_hidrocarburos_variables").first()
    assert loaded["tags"] == "a,b" and loaded["description"] == 'line one\nline "two"'
    assert loaded["warnings_api_original"] is None


def test_staging_area(spark, tmp_path):
    area = tables.Staging(spark, str(tmp_path / "stg"))
    assert area.clear() == list(schemas.STAGING)
    assert area.read("stg_centro").count() == 0
    model = project.to_model(frame(spark, "id_Objecto int", (1,), (2,)), schemas.PLANTS)
    area.append("stg_centro", model)
    area.append("stg_centro", model)
    area.register("t_")
    assert tables.query(spark, "SELECT count(*) FROM t_stg_centro WHERE id_objecto = :k", {"k": 1}).first()[0] == 2
    assert tables.table(spark, "t_stg_centro").count() == 4
    with pytest.raises(ValueError):
        area.append("stg_centro", None)


def price(month, year, company, tariff, sales, income):
    return (month, year, company, tariff, sales, income)


PRICE_SCHEMA = (
    "Mes string, ` Año` string, Empresa string, Tarifa string, Ventas string, `Ingreso con CVG` string"
)


def test_price_cleaning_and_reconciliation(spark):
    raw = frame(
        spark, PRICE_SCHEMA,
        price("ENERO", "2020", " ice", "residencial ", "10", "60"),
        price("ENERO", "2020", "CNFL", "RESIDENCIAL", "n/d", "30"),
        price("ENERO", "2020", "Total Nacional", None, "99", "100"),
        price("ENERO", "2020", None, "X", "1", "1000"),
        price("ENERO", "2020", "nan", "X", "1", "1000"),
        price("BRUMARIO", "2020", "ICE", "X", "1", "1"),
        price("MARZO", "s/d", "ICE", "X", "1", "1"),
        price("FEBRERO", "2020", "ICE", "X", "1", "7"),
    )
    cleaned = recipes.clean_prices(raw).select("Mes", "Año", "Empresa", "Tarifa", "Ventas")
    assert bag(cleaned) == [
        (1, 2020, "CNFL", "RESIDENCIAL", None), (1, 2020, "ICE", "RESIDENCIAL", 10.0),
        (2, 2020, "ICE", "X", 1.0),
    ]
    compared = recipes.price_reconciliation(raw)
    assert rows(compared) == [(2020, "ENERO", 90.0, 100.0, 10.0, 0.0, 10.0)]
    assert rows(recipes.reconciliation_text(compared)) == [
        (2020, "ENERO", "90", "100", "10", "0.00", "10.00%")
    ]


def test_wide_table_keeps_companies_without_climate(spark):
    prices = frame(spark, "Empresa string, `Año` int, Mes int, Ventas double", ("A", 2020, 1, 1.0), ("B", 2020, 1, 2.0))
    weather = frame(spark, "Empresa string, `Año` int, Mes int, T2M double", ("A", 2020, 1, 25.0))
    assert bag(recipes.wide_table(prices, weather).select("Empresa", "T2M")) == [("A", 25.0), ("B", None)]


def test_fuel_recipe_turns_missing_numbers_into_zero(spark):
    raw = frame(
        spark, "producto string, precioFinal string, canon string, rige string, observaciones string, idSIET string",
        ("Diésel", "10.5", None, "si", "o", "1"),
    )
    out = project.to_model(recipes.prepare_fuels(recipes.typed_fuels(raw)), schemas.FUELS).first()
    assert (out["precio_final"], out["canon"], out["rige"], out["tipo_cambio"]) == (10.5, 0.0, True, None)


def test_csv_sink_round_trip(spark, tmp_path):
    df = frame(spark, "a string, b string", ('x "y", z', "línea\nnueva"), (None, "1"))
    files.write_csv(df, str(tmp_path / "o"))
    assert bag(files.read_csv(spark, str(tmp_path / "o"), multiline=True)) == bag(df)
    files.write_parquet(df.withColumn("n", F.lit(1)), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).columns == ["a", "b", "n"]


def test_staging_merge_updates_and_stamps(spark, tmp_path):
    area = tables.Staging(spark, str(tmp_path / "m"))
    area.clear(["stg_zonas"])

    def zones(*data):
        raw = frame(spark, "id_Objecto int, operador string", *data)
        return project.to_model(raw, schemas.ZONES)

    area.append("stg_zonas", zones((1, "a"), (2, "b")))
    before = {r["id_objecto"]: r["fecha_carga"] for r in area.read("stg_zonas").collect()}
    area.merge("stg_zonas", zones((2, None), (3, "c")), ["id_objecto"])
    after = {r["id_objecto"]: (r["operador"], r["srid"], r["fecha_carga"]) for r in area.read("stg_zonas").collect()}
    assert {k: v[:2] for k, v in after.items()} == {1: ("a", 5367), 2: (None, 5367), 3: ("c", 5367)}
    assert after[1][2] == before[1] and after[2][2] > before[2]


def test_rows_with_surplus_cells_are_never_cut(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,2\n3\n4,5,6\n"7,7",8\n"x\ny",9,"z,z"\n')
    (tmp_path / "b.csv").write_text("b,a\n1,2\n1,2,3,4\n")
    pattern = str(tmp_path / "*.csv")
    good = files.read_csv_files(spark, pattern, multiline=True, surplus="reject")
    assert bag(good) == sorted([("1", "2"), ("3", None), ("7,7", "8"), ("2", "1")], key=repr)
    odd = files.csv_rejects(spark, pattern, multiline=True)
    assert sorted(r["record"].strip() for r in odd.collect()) == ["1,2,3,4", "4,5,6", '"x\ny",9,"z,z"'] or odd.count() == 3
    assert good.count() + odd.count() == 7
    assert {r["reject_reasons"][0] for r in odd.collect()} == {files.SURPLUS}
    with pytest.raises(Exception, match=files.SURPLUS):
        files.read_csv_files(spark, pattern, multiline=True).select("a").collect()


def test_header_with_a_line_break(spark, tmp_path):
    (tmp_path / "h.csv").write_text('"a\nb",c\n1,2\n')
    out = files.read_csv_files(spark, str(tmp_path / "h.csv"), multiline=True)
    assert out.count() == 1 and len(out.columns) == 2


def test_a_shared_folder_is_required_beyond_one_process():
    assert session.one_process("local[4]") and session.one_process("local")
    assert not any(map(session.one_process, ("yarn", "local-cluster[2,1,512]", "spark://h:7077", "k8s://x")))


def test_released_tables_are_gone(spark):
    settled = session.materialise(spark.range(3))
    assert settled.count() == 3
    session.release(settled)
    with pytest.raises(Exception):
        spark.read.parquet(settled._settled_in).count()


@pytest.mark.parametrize("multiline", [False, True])
def test_surplus_cells_after_an_empty_one_are_rejected(spark, tmp_path, multiline):
    file = tmp_path / "s.csv"
    file.write_text('a,b\n1,2\n3,4,,5\n6,"7",,,"8"\n8\n,\n')
    kept = files.read_csv(spark, str(file), multiline=multiline, surplus="reject").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([("1", "2"), ("8", None), (None, None)], key=repr)
    found = {r.record.strip() for r in files.csv_rejects(spark, str(file), multiline).collect()}
    assert found == {"3,4,,5", '6,"7",,,"8"'}
    with pytest.raises(Exception, match="more cells than columns"):
        files.read_csv(spark, str(file), multiline=multiline).collect()
