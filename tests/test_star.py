import datetime

import pytest
from helpers import bag, frame, rows
from pyspark.sql import functions as F

from energy_mart import schemas
from energy_mart.operators import project, quality
from energy_mart.plans import geo, jobs, recipes, reports, star, views
from energy_mart.session import empty_frame
from energy_mart.sources.tables import Staging


def staged(spark, **given):
    out = {}
    for name, fields in schemas.STAGING.items():
        if name in given:
            cells = [{k: v for k, v in zip(given[name][0], row)} for row in given[name][1:]]
            raw = spark.createDataFrame(
                [tuple(None if c.get(f.name) is None else str(c[f.name]) for f in fields) for c in cells],
                schemas.text_schema([f.source for f in fields]),
            )
            out[name] = project.to_model(raw, fields)
        else:
            out[name] = empty_frame(spark, schemas.staging_schema(fields))
    return out


SQUARE = "POLYGON ((450000 1000000, 451000 1000000, 451000 1001000, 450000 1000000))"


def sample(spark, sales=10.0, extra_company=False, description="Norte"):
    prices = [
        ("mes", "ano", "empresa", "tarifa", "sistema", "ventas", "ingreso_con_cvg"),
        (1, 2020, "ICE", "RESIDENCIAL", "S1", sales, 5.0),
        (1, 2020, "ICE", "RESIDENCIAL", "S1", 99.0, 5.0),
        (2, 2020, "CNFL", "RESIDENCIAL", None, 3.0, 1.0),
        (13, 2020, "CNFL", "RESIDENCIAL", None, 3.0, 1.0),
    ]
    if extra_company:
        prices.append((3, 2021, "ESPH", "INDUSTRIAL", "S1", 1.0, 1.0))
    return staged(
        spark,
        stg_aresep_medios=prices,
        stg_clima_nasa=[("empresa", "ano", "mes", "t2m"), ("ICE", 2020, 1, 25.5), ("JASEC", 2020, 2, 20.0)],
        stg_centro=[
            ("id_objecto", "operador", "central_electrica", "fuente", "provincia", "canton", "coordenada_x", "coordenada_y"),
            (1, "INSTITUTO COSTARRICENSE DE ELECTRICIDAD", "P1", "HÍDRICA", "CARTAGO", "C", -84.1, 9.8),
            (2, "INSTITUTO COSTARRICENSE DE ELECTRICIDAD", "P2", "EÓLICA", "CARTAGO", "C", -84.1, 9.8),
            (3, "OTRA", "P3", "SOLAR", "HEREDIA", None, -84.2, 9.9),
        ],
        stg_distribucion=[
            ("id_mes", "anho", "empresa", "tipo_tarifa", "descripcion_tarifa", "bloque", "tarifa_promedio", "fecha"),
            (1, 2020, "ICE", "T-RE", "RESIDENCIAL", "0-50", 80.0, None),
            (1, 2020, "ICE", "T-RE", "RESIDENCIAL", "51+", 120.0, None),
            (1, 2020, "ICE", "T-IN", None, None, 50.0, "2020-01-15"),
        ],
        stg_hidrocarburos=[
            ("numero_expediente", "numero_resolucion", "fecha_publicacion", "producto", "precio_final", "rige"),
            ("E1", "R1", "2020-03-05", "Diésel", 600.0, "si"),
            ("E1", "R1", "2020-03-05", "Súper", 700.0, "si"),
            (None, None, "2020-03-06", "Súper", 700.0, ""),
        ],
        stg_zonas=[
            ("id_objecto", "operador", "descripcion", "area", "coordenadas", "tipo_geometria"),
            (1, " ice ", description, 1.5, SQUARE, "POLYGON"),
            (2, "NUEVA R.L.", "Sur", 2.5, SQUARE, "POLYGON"),
            (3, "ICE", "sin mapa", 2.5, None, None),
        ],
    )


def counts(audit):
    return {r["objeto"]: r["filas_insertadas"] for r in audit.orderBy("step").collect()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    warehouse = star.Star(spark, str(tmp_path_factory.mktemp("star")))
    return warehouse, warehouse.load(sample(spark))


def test_first_load(loaded):
    _, audit = loaded
    assert [r["step"] for r in audit.orderBy("step").collect()] == list(range(1, 15))
    assert counts(audit) == {
        "dim_tiempo": 5, "dim_empresa": 3, "dim_tarifa": 5, "dim_ubicacion": 2,
        "dim_central_electrica": 3, "dim_producto_hidrocarburo": 2, "dim_resolucion_hidrocarburo": 1,
        "fact_clima_mensual": 2, "fact_tarifa_electricidad": 2, "fact_distribucion_tarifaria": 3,
        "fact_hidrocarburos": 2, "dim_empresa_zonas": 2, "dim_zona_concesion": 2,
        "bridge_empresa_zona": 3,
    }


def test_grain_first_wins_and_decimals(loaded):
    warehouse, _ = loaded
    fact = warehouse.read("fact_tarifa_electricidad")
    assert dict(fact.dtypes)["ventas"] == "decimal(18,6)"
    assert sorted(float(r["ventas"]) for r in fact.collect()) == [3.0, 10.0]
    for table, (_, grain, _) in schemas.FACTS.items():
        assert quality.repeated_grain(warehouse.read(table), list(grain)).isEmpty()


def test_keys_are_dense_and_references_hold(loaded):
    warehouse, _ = loaded
    for table, (key, natural, _) in schemas.DIMENSIONS.items():
        df = warehouse.read(table)
        keys = sorted(r[0] for r in df.select(key).collect())
        assert keys == list(range(1, len(keys) + 1)), table
        assert quality.repeated_grain(df, [natural]).isEmpty()
    facts = warehouse.read("fact_hidrocarburos")
    dates = warehouse.read("dim_tiempo")
    assert quality.orphan_rows(facts, "tiempo_key", dates, "tiempo_key").isEmpty()
    day = dates.filter(F.col("fecha") == datetime.date(2020, 3, 5)).first()
    assert (day["trimestre"], day["nombre_mes"], day["anio_mes"]) == (1, "Marzo", 202003)


def test_views_and_geography(spark, loaded):
    warehouse, _ = loaded
    views.register_views(warehouse)
    plants = spark.table(views.PLANT_VIEW)
    assert sorted(r["central_electrica"] for r in plants.collect()) == ["P1", "P2"]
    company = spark.table(views.COMPANY_VIEW).first()
    assert (company["empresa_canonica"], company["cantidad_centrales_asociadas"]) == ("ICE", 2)
    assert company["fuentes_electricas_agregadas"] == "EÓLICA, HÍDRICA"
    income = spark.table(views.INCOME_VIEW)
    ice = income.filter("nombre_empresa = 'ICE'").orderBy("bloque_consumo").collect()
    assert [(r["bloque_consumo"], float(r["tarifa_promedio"])) for r in ice] == [("0-50", 80.0), ("51+", 120.0)]
    assert income.filter("nombre_empresa = 'CNFL'").first()["bloque_consumo"] == views.NO_BLOCK
    blocks = reports.block_figures(income)
    assert blocks.count() == 2
    assert reports.block_matrix(blocks, ["0-50", "51+"]).columns == ["nombre_empresa", "0-50", "51+"]
    assert bag(reports.source_matrix(plants, ["EÓLICA", "HÍDRICA"])) == [("ICE", 1.0, 1.0)]


def test_zone_boxes(loaded):
    warehouse, _ = loaded
    zones = warehouse.read("dim_zona_concesion")
    box = geo.zone_boxes(zones, wkt="coordenadas_wkt").orderBy("id_objecto").first()
    assert (box["vertices"], box["parts"]) == (4, 1) and -85 < box["lon_min"] < box["lon_max"] < -84


def test_later_loads(spark, tmp_path):
    warehouse = star.Star(spark, str(tmp_path / "w"))
    warehouse.load(sample(spark))
    before = {r["nombre_empresa"]: r["empresa_key"] for r in warehouse.read("dim_empresa").collect()}
    zones = {r["id_objecto"]: r["zona_key"] for r in warehouse.read("dim_zona_concesion").collect()}
    again = counts(warehouse.load(sample(spark, sales=1.0, description=None)))
    assert again.pop("dim_zona_concesion") == 2 and set(again.values()) == {0}
    fact = warehouse.read("fact_tarifa_electricidad")
    assert sorted(float(r["ventas"]) for r in fact.collect()) == [3.0, 10.0]
    updated = {r["id_objecto"]: (r["zona_key"], r["descripcion"]) for r in warehouse.read("dim_zona_concesion").collect()}
    assert updated == {1: (zones[1], None), 2: (zones[2], "Sur")}

    third = counts(warehouse.load(sample(spark, extra_company=True)))
    assert (third["dim_empresa"], third["dim_tiempo"], third["fact_tarifa_electricidad"]) == (1, 1, 1)
    after = {r["nombre_empresa"]: r["empresa_key"] for r in warehouse.read("dim_empresa").collect()}
    assert {k: after[k] for k in before} == before
    assert after["ESPH"] == max(before.values()) + 1


def contents(warehouse):
    return {name: bag(warehouse.read(name)) for name in warehouse.tables()}


def test_conflicting_zones_are_refused_and_change_nothing(spark, tmp_path):
    warehouse = star.Star(spark, str(tmp_path / "z"))
    warehouse.load(sample(spark))
    before = contents(warehouse)
    staging = sample(spark, extra_company=True)
    other = staging["stg_zonas"].withColumn("descripcion", F.lit("otra"))
    staging["stg_zonas"] = staging["stg_zonas"].unionByName(other)
    with pytest.raises(ValueError, match="different rows") as error:
        warehouse.load(staging)
    listed = spark.read.parquet(str(error.value).rsplit(" ", 1)[1])
    assert listed.count() == 4
    assert contents(warehouse) == before == contents(star.Star(spark, str(tmp_path / "z")))


def test_a_failed_step_changes_no_table(spark, tmp_path, monkeypatch):
    warehouse = star.Star(spark, str(tmp_path / "f"))
    warehouse.load(sample(spark))
    before = contents(warehouse)
    monkeypatch.setattr(star, "bridge_rows", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.load(sample(spark, extra_company=True, description=None))
    assert contents(warehouse) == before == contents(star.Star(spark, str(tmp_path / "f")))
    monkeypatch.undo()
    assert counts(warehouse.load(sample(spark, extra_company=True)))["dim_empresa"] == 1


def test_corrected_measures_replace_facts_on_request(spark, tmp_path):
    warehouse = star.Star(spark, str(tmp_path / "u"))
    warehouse.load(sample(spark))
    keys = {r["fact_tarifa_key"] for r in warehouse.read("fact_tarifa_electricidad").collect()}
    warehouse.load(sample(spark, sales=77.0), update_facts=True)
    fact = warehouse.read("fact_tarifa_electricidad").collect()
    assert 77.0 in {float(r["ventas"]) for r in fact} and {r["fact_tarifa_key"] for r in fact} == keys
    plan = warehouse._read("fact_tarifa_electricidad").filter("anio in (2020)")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan or "PartitionFilters: [(anio" in plan


def test_rows_wider_than_the_star_are_rejected(spark, tmp_path):
    staging = sample(spark)
    wide = staging["stg_aresep_medios"].withColumn("tarifa", F.lit("t" * 110))
    staging["stg_aresep_medios"] = staging["stg_aresep_medios"].unionByName(wide)
    warehouse = star.Star(spark, str(tmp_path / "x"))
    assert counts(warehouse.load(staging))["dim_tarifa"] == 5
    reasons = {r[quality.REASONS][0] for r in warehouse.rejects("dim_tarifa").collect()}
    assert reasons == {"nombre_tarifa longer than 100"}
    assert warehouse.rejects("dim_ubicacion").count() == 0


def test_multipolygons_and_records(spark):
    wkt = "MULTIPOLYGON(((1 2, 3 4),(5 6, 7 8)), ((9 1e1, -1.5 2)))"
    df = frame(spark, "id_objecto int, operador string, descripcion string, area double, coordenadas string",
               (1, "Esph ", "d", 1.236, wkt), (2, "X", None, None, None))
    found = geo.zone_vertices(df).select("part", "ring", "vertex", "x", "y")
    assert bag(found) == [
        (0, 0, 0, 1.0, 2.0), (0, 0, 1, 3.0, 4.0), (0, 1, 0, 5.0, 6.0), (0, 1, 1, 7.0, 8.0),
        (1, 0, 0, 9.0, 10.0), (1, 0, 1, -1.5, 2.0),
    ]
    assert bag(geo.zone_records(df)) == [
        (1, "Esph ", "Heredia", "d", 1.24, 5367), (2, "X", "Zona no definida", None, None, 5367),
    ]


def test_report_base_and_filters(spark):
    wide = frame(
        spark, "empresa string, tarifa string, ano int, mes int, ventas double, t2m double",
        ("ICE", "RESIDENCIAL", 2020, 1, 10.0, -999.0), ("ICE", "RESIDENCIAL", 2022, 6, 20.0, 25.0),
        ("CNFL", "INDUSTRIAL", 2024, 12, 5.0, 20.0),
    )
    df = reports.base(wide)
    assert rows(df.select("t2m", "periodo").filter("ano = 2020")) == [(None, "Pandemia (2020-2021)")]
    change = reports.period_change(df).filter("tarifa_label = 'Residencial (Hogares)'").first()
    assert change["var_pct"] == 100.0
    assert reports.filtered(df, years=[2020, 2022], companies=["ICE"]).count() == 2
    assert rows(reports.choices(df, "empresa")) == [("CNFL",), ("ICE",)]


def test_full_load_from_landed_frames(spark, tmp_path):
    header = [f.source for f in schemas.PRICES]
    row = dict.fromkeys(header)

    def price(**given):
        return tuple({**row, **given}.get(h) for h in header)

    prices = spark.createDataFrame(
        [
            price(Mes="ENERO", **{"Año": "2020"}, Empresa="ice", Tarifa="RESIDENCIAL", Ventas="10"),
            price(Mes="ENERO", **{"Año": "2020"}, Empresa="x" * 30, Tarifa="RESIDENCIAL", Ventas="10"),
            price(Mes="ENERO", **{"Año": "2020"}, Empresa="TOTAL NACIONAL", Tarifa="T", Ventas="10"),
        ],
        schemas.text_schema(header),
    )
    zones = frame(
        spark, "id_Objecto int, operador string, descripcion string, area double, coordenadas string",
        (1, "ice", "d", 1.0, SQUARE), (1, "ice", "later", 1.0, SQUARE),
    ).coalesce(1)
    root = str(tmp_path / "dw")
    for _ in range(2):  # rejects of an earlier run are forgotten
        jobs.full_load(spark, {"stg_aresep_medios": prices, "stg_zonas": zones}, root)
    root = str(tmp_path / "dw2")
    summary, audit = jobs.full_load(spark, {"stg_aresep_medios": prices, "stg_zonas": zones}, root)
    assert bag(summary) == [("stg_aresep_medios", 2, 1, 1), ("stg_zonas", 2, 1, 1)]
    rejected = Staging(spark, f"{root}/staging").rejects("stg_aresep_medios").first()
    assert rejected[quality.REASONS] == ["empresa longer than 25"]
    again = Staging(spark, str(tmp_path / "dw" / "staging"))
    assert again.rejects("stg_aresep_medios").count() == again.rejects("stg_zonas").count() == 1
    assert again.rejects("stg_zonas").first()["descripcion"] == "later"
    found = counts(audit)
    assert (found["fact_tarifa_electricidad"], found["dim_zona_concesion"], found["bridge_empresa_zona"]) == (1, 1, 2)
    staged_zone = Staging(spark, f"{root}/staging").read("stg_zonas").first()
    assert staged_zone["srid"] == 5367 and staged_zone["fecha_carga"] is not None


def test_wide_dataset_files(spark, tmp_path):
    (tmp_path / "p1.csv").write_text("Mes,Año,Empresa,Tarifa,Ventas,Ingreso con CVG\nENERO,2020,ice,RES,1,2\n")
    (tmp_path / "p2.csv").write_text("Mes,Año,Empresa,Tarifa,Ventas,Ingreso con CVG\nENERO,2020,Total Nacional,,1,3\n")
    (tmp_path / "c.csv").write_text("Empresa,Año,Mes,T2M\nICE,2020,1,25.5\n")
    out = jobs.wide_dataset(spark, str(tmp_path / "p*.csv"), str(tmp_path / "c.csv"), str(tmp_path / "out"))
    assert rows(out.wide.select("Empresa", "Mes", "T2M")) == [("ICE", 1, 25.5)]
    df = reports.base(recipes.report_table(out.wide))
    assert rows(df.select("empresa", "ano", "ventas", "t2m", "estacion")) == [("ICE", 2020, 1.0, 25.5, "Verano (Dic-Abr)")]
    assert rows(out.reconciliation.select("parts", "published")) == [(2.0, 3.0)]
    stored = spark.read.option("header", True).csv(str(tmp_path / "out" / jobs.WIDE_FILE))
    assert stored.count() == 1 and "Ingreso con CVG" in stored.columns
