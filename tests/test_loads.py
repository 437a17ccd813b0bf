from threading import Barrier

import pytest
from helpers import bag, frame, rows
from pyspark.sql import functions as F
from test_star import counts, sample

from energy_mart import schemas
from energy_mart.checks import loads, standins
from energy_mart.operators import profile, quality, wide
from energy_mart.plans import geo, jobs, star
from energy_mart.sources import climate, files, tables
from energy_mart.sources.versions import Conflict, State, Versions, load_name


# ---- versions -----------------------------------------------------------------------

def test_versions_refuse_a_second_writer_of_the_same_table(spark, tmp_path):
    root = str(tmp_path / "v")
    one, two = Versions(spark, root), Versions(spark, root)
    assert one.current() == {} and one.number() == 0
    one.publish({"a": State(("x",), 1)}, made_from=["a"])
    two.publish(lambda now: {"b": State((*now["a"].folders, "y"), 0)})  # goes on after the other's version
    assert two.refresh() == {"a": State(("x",), 1), "b": State(("x", "y"), 0)}
    one.refresh(), two.refresh()
    one.publish({"a": State(("z",), 2)}, made_from=["a"])
    with pytest.raises(Conflict):
        two.publish({"a": State(("w",), 2)}, made_from=["a"])
    assert Versions(spark, root).current()["a"] == State(("z",), 2)
    two.refresh()
    two.publish({"b": State((), 0)}, made_from=["b"])
    assert Versions(spark, root).numbers() == [1, 2, 3, 4]
    assert one.at(1) == {"a": State(("x",), 1)}


def test_a_taken_number_is_not_overwritten(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions._claim(1, {"a": State((), 0)}) and not versions._claim(1, {"b": State((), 0)})
    assert versions.current() == {"a": State((), 0)}
    assert [p.name for p in (tmp_path / "v" / "_versions").iterdir() if not p.name.startswith(".")] == ["000000000001.json"]


def test_appends_of_two_writers_and_compaction(spark, tmp_path):
    root = str(tmp_path / "stg")
    one, two = tables.Staging(spark, root), tables.Staging(spark, root)
    model = "id_objecto int, operador string"
    one.clear(["stg_centro"]), two.versions.refresh()
    for k in range(4):
        (one, two)[k % 2].append("stg_centro", _plants(spark, k))
    assert sorted(r.id_objecto for r in tables.Staging(spark, root).read("stg_centro").collect()) == [0, 1, 2, 3]
    merged = one.compact("stg_centro")
    assert merged == 5 and len(one.versions.current()["stg_centro"].folders) == 1
    two.append("stg_centro", _plants(spark, 9))
    again = tables.Staging(spark, root)
    assert again.read("stg_centro").count() == 5
    assert again.compact("stg_centro", small=1) == 0
    with pytest.raises(Conflict):
        one.merge("stg_centro", _plants(spark, 0), ["id_objecto"])  # made from what was there before the append
    gone = again.versions.expire(keep=1, hours=0)
    assert len(gone) == 6 and again.versions.numbers()[-1:] == again.versions.numbers() and again.read("stg_centro").count() == 5
    assert model.split()[0] in again.read("stg_centro").columns


def _plants(spark, k):
    fields = [f"{f.name} {f.type}" for f in schemas.PLANTS]
    row = [None] * len(fields)
    row[0] = k
    return frame(spark, ", ".join(fields), tuple(row))


def test_expiry_spares_young_folders(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    kept, young = versions.fresh_folder("a"), versions.fresh_folder("a")
    for folder in (kept, young):
        spark.range(3).write.parquet(folder)
    versions.publish({"a": State((kept,), 0)})
    assert versions.expire(keep=1, hours=1) == []
    assert [load_name(p) for p in versions.expire(keep=1, hours=0)] == [load_name(young)]
    assert load_name(f"{kept}/anio=1995") == load_name(kept)


# ---- star ---------------------------------------------------------------------------

def test_a_load_that_is_overtaken_is_made_again(spark, tmp_path):
    root = str(tmp_path / "star")
    late, quick = star.Star(spark, root), star.Star(spark, root)
    plain, turns = late._check, []

    def overtaken():
        if not turns:
            turns.append(counts(quick.load(sample(spark))))
        plain()

    late._check = overtaken
    audit = counts(late.load(sample(spark, extra_company=True)))
    # Made again on the other's rows, only what it does not have is inserted.
    assert audit["fact_tarifa_electricidad"] == 1 and audit["dim_empresa"] == 1 and turns[0]["fact_tarifa_electricidad"] == 2
    found = star.Star(spark, root)
    for table, (key, grain, _) in schemas.FACTS.items():
        assert quality.repeated_grain(found.read(table), list(grain)).isEmpty()
        assert quality.repeated_grain(found.read(table), [key]).isEmpty()
    assert found.read("fact_tarifa_electricidad").count() == 3


def test_a_load_that_is_always_overtaken_stops(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "star")
    late, quick = star.Star(spark, root), star.Star(spark, root)
    quick.load(sample(spark))
    monkeypatch.setattr(star, "RETRIES", 1)
    plain, turns = late._check, []

    def overtaken():
        turns.append(1)
        quick.versions.refresh()
        state = quick.versions.current()["dim_empresa"]
        quick.versions.publish({"dim_empresa": State(state.folders, state.top_key + 1)})
        plain()

    late._check = overtaken
    with pytest.raises(Conflict):
        late.load(sample(spark, extra_company=True))
    assert len(turns) == 2 and late.read("fact_tarifa_electricidad").count() == 2


def test_corrections_write_their_year_only(spark, tmp_path):
    target = star.Star(spark, str(tmp_path / "star"))
    target.load(sample(spark, extra_company=True))
    name = "fact_tarifa_electricidad"
    before = {f.rsplit("=", 1)[1]: f for f in target.versions.current()[name].folders}
    assert set(before) == {"2020", "2021"}
    target.load(sample(spark, sales=7.0), update_facts=True)
    now = {f.rsplit("=", 1)[1]: f for f in target.versions.refresh()[name].folders}
    assert now["2021"] == before["2021"] and now["2020"] != before["2020"]
    assert sorted(float(r.ventas) for r in target.read(name).collect()) == [1.0, 3.0, 7.0]
    merged = target.compact()
    assert merged[name] == 0 and target.read(name).count() == 3
    target.load(sample(spark, sales=7.0, extra_company=True))
    assert target.read("fact_clima_mensual").count() == 2


def test_facts_of_many_loads_are_merged_within_their_year(spark, tmp_path):
    target = star.Star(spark, str(tmp_path / "star"))
    target.load(sample(spark))
    target.load(sample(spark, extra_company=True))
    name = "fact_tarifa_electricidad"
    state = target.versions.current()[name]
    rows_2020 = target._read(name, [f for f in state.folders if f.endswith("=2020")])
    more = target._write(name, rows_2020.limit(0).unionByName(rows_2020.limit(1).withColumn("empresa_key", F.lit(99).cast("long"))))
    target.versions.publish({name: State((*state.folders, *more), state.top_key)})
    before = target.read(name).count()
    assert target.compact()[name] == 2
    folders = target.versions.current()[name].folders
    assert sorted(f.rsplit("=", 1)[1] for f in folders) == ["2020", "2021"] and target.read(name).count() == before


def test_losses_and_dropped_columns_of_a_load(spark, tmp_path):
    target = star.Star(spark, str(tmp_path / "star"))
    target.load(sample(spark), dropped=[("stg_distribucion", "pliego")])
    found = {(r.objeto, r.busqueda): (r.filas, r.perdidas) for r in target.losses().collect()}
    assert found["fact_tarifa_electricidad", "dim_tiempo"] == (4, 1)  # month 13
    assert found["fact_tarifa_electricidad", "dim_empresa"] == (3, 0)
    assert found["fact_hidrocarburos", "dim_resolucion_hidrocarburo"] == (3, 1)
    assert found["stg_distribucion", "columna pliego"] == (None, None)


@pytest.mark.parametrize("broken, rule", [
    ("dim_tarifa", "unique tarifa_nk"), ("fact_clima_mensual", "unique tiempo_key, empresa_key"),
])
def test_a_broken_table_blocks_the_load(spark, tmp_path, broken, rule):
    target = star.Star(spark, str(tmp_path / "star"))
    target.load(sample(spark))
    state = target.versions.current()[broken]
    twice = target._write(broken, target._read(broken))
    target.versions.publish({broken: State((*state.folders, *twice), state.top_key)})
    number = target.versions.number()
    later = dict(sample(spark, extra_company=True))
    extra = frame(spark, "empresa string, ano int, mes int", ("ESPH", 2020, 1))
    later["stg_clima_nasa"] = later["stg_clima_nasa"].unionByName(extra, allowMissingColumns=True)
    with pytest.raises(star.BrokenConstraint) as stopped:
        target.load(later)
    assert (broken, rule) in {(t, r) for t, r, _ in stopped.value.broken}
    assert target.versions.refresh()[broken].folders == (*state.folders, *twice) and target.versions.number() == number


def test_full_load_names_dropped_columns(spark, tmp_path):
    header = [f.source for f in schemas.DISTRIBUTION]
    whole = dict(zip(header, ["1", "Enero", "2020", None, "ICE", "T-RE", "R", "0-50", "80", None, "p", "e", "x", "r", None]))
    raw = spark.createDataFrame([tuple(whole[h] for h in header), tuple({**whole, "bloque": None}[h] for h in header)], schemas.text_schema(header))
    jobs.full_load(spark, {"stg_distribucion": raw}, str(tmp_path / "dw"))
    lost = star.Star(spark, str(tmp_path / "dw" / "star")).losses().filter("objeto = 'stg_distribucion'")
    assert "columna bloque" in {r.busqueda for r in lost.collect()}


# ---- payloads and geometries --------------------------------------------------------

GOOD = '{"properties":{"parameter":{"T2M":{"202001":1.5,"202002":null,"202013":3},"PS":{"202001":7}}}}'


def test_payloads_are_read_whole_or_rejected(spark):
    given = [
        (0, GOOD, None), (1, None, "no payload"), (2, "  ", "no payload"), (3, GOOD[:-9], "not JSON"), (4, "[1]", "no series of variables"),
        (5, '{"properties":{}}', "no series of variables"), (6, '{"properties":{"parameter":{"T2M":3}}}', "a variable without a series"),
        (7, GOOD.replace("1.5", '"1.5"'), "a value that is not a number"), (8, GOOD.replace("1.5", "[1]"), "a value that is not a number"),
        (9, GOOD.replace("202001", "total"), "a key that is not a month"), (10, '{"properties":{"parameter":{}}}', None),
    ]
    df = frame(spark, "id int, payload string, extra string", *[(i, p, "x") for i, p, _ in given])
    accepted, rejected = climate.split_payloads(df)
    assert bag(accepted.select("id")) == [(i,) for i, _, why in given if why is None]
    assert {r.id: r.reject_reasons for r in rejected.collect()} == {i: [why] for i, _, why in given if why}
    cells = bag(climate.payload_cells(df, keep=["id"]))
    assert cells == [(0, "PS", "202001", 7.0), (0, "T2M", "202001", 1.5), (0, "T2M", "202002", None)]
    none = climate.split_payloads(df.limit(0))
    assert none[0].isEmpty() and none[1].isEmpty()


RING = "1 1, 2 1, 2 2, 1 1"
ZONES = [
    (f"POLYGON (({RING}))", None, 4), (f"polygon(({RING}),({RING}))", None, 8), (f"MULTIPOLYGON ((({RING})), (({RING}), ({RING})))", None, 12),
    ("POINT (3.5e2 -4)", None, 1), ("POLYGON((1 1, 2 1, 2 2, 1 1.0))", None, 4),
    ("POLYGON((5 1, 2 1, 5o1 2, 5 1))", "not a geometry", 0), ("POLYGON((bad))", "not a geometry", 0), (f"POLYGON (({RING})", "not a geometry", 0),
    (f"POLYGON ({RING})", "not a geometry", 0), (f"POLYGON (({RING}), 1 1)", "not a geometry", 0), (f"POLYGON (({RING}) ({RING}))", "not a geometry", 0),
    ("POLYGON((1 1, 2, 2 2, 1 1))", "not a geometry", 0), ("POLYGON((1 1 1, 2 1 1, 2 2 1, 1 1 1))", "not a geometry", 0), ("POINT(1 1, 2 2)", "not a geometry", 0),
    ("POLYGON EMPTY", "not a geometry", 0), ("", "not a geometry", 0), (None, "no geometry", 0),
    ("POLYGON((1 1, 2 1, 2 2, 1 3))", "a ring that is not closed", 0), (f"MULTIPOLYGON((({RING})),((1 1,2 2,3 3,4 4)))", "a ring that is not closed", 0),
    ("POLYGON((1 1, 2 1, 1 1))", "a ring of fewer than four points", 0),
]


def test_zones_are_read_whole_or_rejected(spark):
    df = frame(spark, "id_objecto int, coordenadas string", *[(i, w) for i, (w, _, _) in enumerate(ZONES)])
    accepted, rejected = geo.split_zones(df)
    assert {r.id_objecto: r.reject_reasons for r in rejected.collect()} == {i: [why] for i, (_, why, _) in enumerate(ZONES) if why}
    assert accepted.count() + rejected.count() == len(ZONES)
    points = {r.id_objecto: r["count"] for r in geo.zone_vertices(df).groupBy("id_objecto").count().collect()}
    assert points == {i: n for i, (_, _, n) in enumerate(ZONES) if n}


def test_a_very_long_ring_is_read(spark):
    ring = ", ".join(f"{k} {k % 7}" for k in range(60_000))
    df = frame(spark, "id_objecto int, coordenadas string", (1, f"POLYGON(({ring}, 0 0))"))
    assert geo.zone_vertices(df).count() == 60_001


def test_zones_of_one_file_are_judged_by_all_tasks_and_once(spark, tmp_path):
    spark.range(2000).selectExpr("CAST(id AS INT) AS id_objecto", f"'POLYGON (({RING}))' AS coordenadas").coalesce(1).write.parquet(str(tmp_path / "z"))
    accepted, rejected = geo.split_zones(spark.read.parquet(str(tmp_path / "z")))
    assert accepted.select(F.input_file_name()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "regexp" not in accepted._jdf.queryExecution().toString() + rejected._jdf.queryExecution().toString()


# ---- wide correlations --------------------------------------------------------------

@pytest.mark.parametrize("block", [3, 256])
def test_wide_correlations_equal_the_plain_ones(spark, block):
    cells = [f"CASE WHEN (id + {i}) % 5 <> 0 THEN sin(id * {i + 1}) * 1000 + 1e6 + id * {i % 3} END AS c{i}" for i in range(7)]
    df = spark.range(200).repartition(3).selectExpr(*cells, "CAST(4 AS double) AS flat", "CAST(NULL AS double) AS gone", "if(id = 3, double('NaN'), id) AS odd")
    want = {(r.a, r.b): r.corr for r in profile.correlations(df.drop("flat", "gone")).collect()}
    got = wide.wide_correlations(df, block=block).collect()
    assert len(got) == 10 * 9 // 2
    for r in got:
        # Columns without spread, or without a value, correlate with nothing.
        if {r.a, r.b} & {"flat", "gone"}:
            assert r.corr is None
        else:
            assert r.corr == pytest.approx(want[r.a, r.b], abs=1e-9)
    assert {(r.a, r.b): r.n for r in got}["c0", "odd"] == 160 - (3 % 5 != 0)
    assert all(r.corr is None and r.n == 0 for r in wide.wide_correlations(df.limit(0), ["c0", "c1"]).collect())


def test_wide_cells_of_one_file_are_made_by_all_tasks(spark, tmp_path, monkeypatch):
    cells = "id AS p_partkey", "CAST(id AS DOUBLE) AS p_retailprice", "CAST(id % 50 AS INT) AS p_size", "'x' AS p_name"
    spark.range(3000).selectExpr(*cells).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(wide, "wide_correlations", lambda df: df.select("c0", F.spark_partition_id().alias("corr")))
    made = loads.wide_correlations(spark, str(tmp_path))
    assert made.count() == 3000 and made.select("corr").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_centres_of_wide_columns(spark):
    df = spark.range(10, numPartitions=3).selectExpr("IF(id % 2 = 0, 1e6 + id, NULL) AS a", "CAST(NULL AS DOUBLE) AS b", "CAST(id AS DOUBLE) AS c")
    assert wide._centres(df, ["a", "b", "c"], 2) == {"a": 1e6 + 4, "b": 0.0, "c": 4.5}
    assert wide._centres(df.limit(0), ["a", "b", "c"], 2) == {"a": 0.0, "b": 0.0, "c": 0.0}



# ---- CSV ranges and headers ---------------------------------------------------------

TRICKY = [("1", "a,b", 'say "x"'), ("2", "two\nlines", ""), ("3", "\n\n", "NA"), ("4", '""\n"', "x" * 300), ("5", "é\nñ,\n\",\"", "z"), ("6", None, "end")]


@pytest.mark.parametrize("size", ["40", "128m"])
def test_split_records_equal_the_whole_read(spark, tmp_path, size):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(f"{k}{a}", b, c) for k in range(40) for a, b, c in TRICKY], "id string, text string, note string")
    files.write_csv(df.coalesce(2), path)
    want = bag(files.read_csv(spark, path, multiline=True))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        got = files.read_csv_split(spark, path)
        assert bag(got) == want and got.columns == ["id", "text", "note"]
    finally:
        spark.conf.set(key, before)


def test_split_records_with_surplus_and_missing_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2\r\n\r\n3,4,5\r\n6,\r\n')
    path = str(tmp_path / "a.csv")
    assert bag(files.read_csv_split(spark, path, surplus="reject")) == [("1", "x\r\ny"), ("2", None), ("6", None)]
    with pytest.raises(Exception, match=files.SURPLUS):
        files.read_csv_split(spark, path).collect()
    (tmp_path / "none.csv").write_text("a,b\n")
    assert rows(files.read_csv_split(spark, str(tmp_path / "none.csv"))) == []


def test_headers_are_read_by_a_job(spark, tmp_path):
    (tmp_path / "a b%.csv").write_text('x,"y\nz"\n1,2\n')
    (tmp_path / "c.csv").write_text("﻿x,w\n3,4\n")
    (tmp_path / "empty.csv").write_text("")
    found = files._layouts(spark, str(tmp_path / "*.csv"), {})
    assert {h: [f.rsplit("/", 1)[1] for f in fs] for h, fs in found.items()} == {("x", "y\nz"): ["a b%.csv"], ("x", "w"): ["c.csv"], (): ["empty.csv"]}


def test_texts_are_written_by_as_many_tasks_as_read_them(spark, tmp_path, monkeypatch):
    cells = "id AS doc_id", "repeat('a, \"b\"\n', 1000) AS text", "'en' AS lang", "'s' AS source"
    spark.range(60, numPartitions=6).selectExpr(*cells).write.parquet(str(tmp_path / "documents.parquet"))
    write, tasks = files.write_csv, []
    monkeypatch.setattr(files, "write_csv", lambda df, path: (tasks.append(df.rdd.getNumPartitions()), write(df, path)))
    got = loads.split_records(spark, str(tmp_path))
    assert got.filter("en_rangos").count() == 60 and got.select("texto").distinct().count() == 1
    assert tasks == [spark.read.parquet(str(tmp_path / "documents.parquet")).rdd.getNumPartitions()] and tasks[0] > 2


def test_staging_tables_are_stored_side_by_side(spark, monkeypatch):
    both, store = Barrier(2, timeout=60), standins.materialise
    monkeypatch.setattr(standins, "materialise", lambda df: (both.wait(), store(df))[1])
    staged = standins.staging(spark, "/root/testdata/sf0.001", ("stg_centro", "stg_zonas"))
    assert list(staged) == list(schemas.STAGING) and staged["stg_zonas"].count() > 0 and staged["stg_clima_nasa"].count() == 0


def test_small_ranges_share_tasks(spark, tmp_path):
    path, size = str(tmp_path / "csv"), "spark.sql.files.maxPartitionBytes"
    cells = "id", "repeat('a, \"b\"\n', CAST(id % 50 AS int)) || 'z' AS text"
    files.write_csv(spark.range(1000, numPartitions=2).selectExpr(*cells), path)
    want = bag(spark.range(1000).selectExpr("CAST(id AS string)", cells[1]))
    before, context = spark.conf.get(size), spark.sparkContext
    spark.conf.set(size, "1000")
    context.setJobGroup("ranges", "")
    try:
        ranges = spark.read.text(path).rdd.getNumPartitions()
        got = files.read_csv_split(spark, path)
    finally:
        spark.conf.set(size, before)
        context.setJobGroup("others", "")
    stages = [context.statusTracker().getJobInfo(j).stageIds for j in context.statusTracker().getJobIdsForGroup("ranges")]
    found = [context.statusTracker().getStageInfo(i) for i in {i for ids in stages for i in ids}]
    # Headers, and each pass over the ranges.
    assert sum(i.numTasks for i in found if i) < 100 < ranges
    assert bag(got) == want and spark.conf.get(size) == before


@pytest.mark.parametrize("share", [1, 60, 1 << 24])
@pytest.mark.parametrize("size", ["7", "30", "200"])
def test_pieces_of_records_and_headers_across_ranges(spark, tmp_path, monkeypatch, size, share):
    """Headers and records longer than a range, blank lines, a quote that is never closed; the bytes stay as they are."""
    monkeypatch.setattr(files, "TASK_BYTES", share)
    (tmp_path / "a.csv").write_bytes(b'"k' + b"\nx" * 20 + b'",v\n1,"a\n\n\xff""\n' + b"y\n" * 30 + b'"\r\n\n2,"z"\r\n3,"\n"\n')
    (tmp_path / "b.csv").write_bytes(b'k,v\n4,5\n6,7')
    (tmp_path / "c.csv").write_bytes(b'k,v\n8,"open\n9,10\n11,12\n')
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        got = files._record_pieces(spark, files.input_files(spark, str(tmp_path)), "UTF-8")
        read = files.read_csv_split(spark, str(tmp_path), ["k", "v"], surplus="reject")
    finally:
        spark.conf.set(key, before)
    pieces = got.withColumn("piece", F.col("piece").cast("binary")).collect()
    by_opener = {}
    for r in sorted((r for r in pieces if r["opener"] is not None), key=lambda r: r["start"]):
        by_opener.setdefault(r["opener"], []).append(r)
    joined = [b"\n".join(bytes(r["piece"]) for r in rs) for rs in by_opener.values() if not any(r["header"] for r in rs)]
    records = [bytes(r["piece"]) for r in pieces if r["opener"] is None]
    want = [b'1,"a\n\n\xff""\n' + b"y\n" * 30 + b'"\r', b'2,"z"\r', b'3,"\n"', b"", b"4,5", b"6,7", b'8,"open\n9,10\n11,12']
    assert sorted(records + joined) == sorted(want)
    # The open quote hides where its record ends.
    assert sorted(r["k"] for r in read.collect()) == ["1", "2", "3", "4", "6"]
