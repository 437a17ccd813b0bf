"""Star schema: dimension and fact rows from staging, and the repeatable load.

Every step inserts only what is new by natural key or grain and never changes existing
rows, except zones, which are updated, and facts where the caller asks for it. A load writes new
folders, checks the constraints of the tables it changed, and publishes all as one version at its
end; one that fails or breaks a constraint changes nothing, and one that was overtaken by another load is
made again on the other's rows. Rows that a lookup drops are counted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from energy_mart.functions.dates import date_parts, month_date
from energy_mart.functions.geo import SRID
from energy_mart.functions.numbers import nan_to_null
from energy_mart.functions.text import natural_key
from energy_mart.operators import quality
from energy_mart.operators.merge import absent_rows, conflicting_keys, first_by, upsert
from energy_mart.operators.numbering import dense_numbers
from energy_mart.operators.project import stack_by_name
from energy_mart.schemas import BRIDGE, DIMENSIONS, FACTS, MEASURE, STAR_WIDTHS
from energy_mart.session import empty_frame, hadoop_path, literal_rows, materialise
from energy_mart.sources.tables import SMALL
from energy_mart.sources.versions import Conflict, State, Versions, merge_small

Frames = Mapping[str, DataFrame]
LINK_SOURCE = "OPERADOR"
# Column that facts are partitioned by on disk; not part of the tables as read.
YEAR = "anio"


# ---- natural keys -------------------------------------------------------------------

def _number_part(c: Column) -> Column:
    """A number inside a natural key: fixed decimals, so both sides print alike."""
    return c.cast(MEASURE)


def price_tariff_key() -> Column:
    return natural_key(F.col("tarifa"), F.col("sistema"), F.col("trimestral"), prefix="MEDIOS")


def distribution_tariff_key() -> Column:
    return natural_key(
        F.col("tipo_tarifa"), F.col("descripcion_tarifa"), F.col("bloque"),
        _number_part(F.col("tarifa")), F.col("pliego"), F.col("estructura_costos"),
        prefix="DISTRIBUCION",
    )


def location_key() -> Column:
    return natural_key(
        F.col("provincia"), F.col("canton"), F.col("distrito"), F.col("codigo_dta"),
        F.col("coordenada_x").cast("decimal(24,10)"), F.col("coordenada_y").cast("decimal(24,10)"),
    )


def resolution_key() -> Column:
    return natural_key(
        F.col("numero_expediente"), F.col("numero_resolucion"), F.col("fecha_publicacion")
    )


# ---- dimension rows -----------------------------------------------------------------

def distribution_date() -> Column:
    return F.coalesce(F.col("fecha"), month_date(F.col("anho"), F.col("id_mes")))


def date_rows(staging: Frames) -> DataFrame:
    monthly = [
        staging[name].select(month_date(F.col("ano"), F.col("mes")).alias("fecha"))
        for name in ("stg_clima_nasa", "stg_aresep_medios")
    ]
    tariffs = (
        staging["stg_distribucion"]
        .filter(F.col("anho").isNotNull() & F.col("id_mes").between(1, 12))
        .select(distribution_date().alias("fecha"))
    )
    fuels = staging["stg_hidrocarburos"].select(F.col("fecha_publicacion").alias("fecha"))
    dates = stack_by_name([*monthly, tariffs, fuels]).filter(F.col("fecha").isNotNull()).distinct()
    return dates.select("fecha", *[c.alias(n) for n, c in date_parts(F.col("fecha")).items()])


def company_rows(staging: Frames) -> DataFrame:
    names = [
        staging[t].select(F.col("empresa").alias("nombre_empresa"))
        for t in ("stg_clima_nasa", "stg_aresep_medios", "stg_distribucion")
    ]
    return stack_by_name(names).filter(F.col("nombre_empresa").isNotNull()).distinct()


def zone_company_rows(staging: Frames) -> DataFrame:
    name = F.trim("operador")
    zones = staging["stg_zonas"].select(name.alias("nombre_empresa"))
    return zones.filter(F.col("nombre_empresa") != "").distinct()


def tariff_rows(staging: Frames) -> DataFrame:
    """Two tariff shapes under one key; the first row of a key wins by its attributes."""
    prices = (
        staging["stg_aresep_medios"]
        .filter(F.col("tarifa").isNotNull())
        .select(
            price_tariff_key().alias("tarifa_nk"),
            F.col("tarifa").alias("nombre_tarifa"),
            F.lit(None).cast("string").alias("tipo_tarifa"),
            F.lit(None).cast("string").alias("descripcion_tarifa"),
            F.lit(None).cast("string").alias("bloque"),
            "sistema",
            F.col("trimestral").alias("indicador_trimestral"),
        )
    )
    distribution = (
        staging["stg_distribucion"]
        .filter(F.col("tipo_tarifa").isNotNull() | F.col("descripcion_tarifa").isNotNull())
        .select(
            distribution_tariff_key().alias("tarifa_nk"),
            F.coalesce("descripcion_tarifa", "tipo_tarifa").alias("nombre_tarifa"),
            "tipo_tarifa",
            "descripcion_tarifa",
            "bloque",
            F.lit(None).cast("string").alias("sistema"),
            F.lit(None).cast("string").alias("indicador_trimestral"),
        )
    )
    return first_by(prices.unionByName(distribution), ["tarifa_nk"])


def location_rows(staging: Frames) -> DataFrame:
    plants = staging["stg_centro"].select(
        location_key().alias("ubicacion_nk"),
        "provincia", "canton", "distrito", "codigo_dta", "coordenada_x", "coordenada_y",
    )
    return first_by(plants, ["ubicacion_nk"])


def plant_rows(staging: Frames, locations: DataFrame) -> DataFrame:
    plants = (
        staging["stg_centro"]
        .filter(F.col("id_objecto").isNotNull())
        .withColumn("ubicacion_nk", location_key())
    )
    joined = plants.join(locations.select("ubicacion_nk", "ubicacion_key"), "ubicacion_nk")
    return first_by(
        joined.select("id_objecto", "operador", "central_electrica", "fuente", "ubicacion_key"),
        ["id_objecto"],
    )


def product_rows(staging: Frames) -> DataFrame:
    return staging["stg_hidrocarburos"].select("producto").dropna().distinct()


def resolution_rows(staging: Frames) -> DataFrame:
    rows = (
        staging["stg_hidrocarburos"]
        .filter(F.col("numero_resolucion").isNotNull() | F.col("numero_expediente").isNotNull())
        .select(
            resolution_key().alias("resolucion_nk"),
            "numero_expediente", "numero_resolucion", "fecha_publicacion", "alcance_gaceta",
            "numero_gaceta", "rige",
        )
    )
    return first_by(rows, ["resolucion_nk"])


def zone_rows(staging: Frames) -> DataFrame:
    zones = staging["stg_zonas"]
    srid = F.col("srid") if "srid" in zones.columns else F.lit(None).cast("int")
    return (
        zones.filter(F.col("id_objecto").isNotNull() & F.col("coordenadas").isNotNull())
        .select(
            "id_objecto", "operador", "descripcion", "area",
            F.col("coordenadas").alias("coordenadas_wkt"), "tipo_geometria",
            F.coalesce(srid, F.lit(SRID)).alias("srid"),
        )
        .distinct()
    )


def bridge_rows(zones: DataFrame, companies: DataFrame) -> DataFrame:
    """Companies and zones whose operator name agrees after trim and upper case."""
    z = zones.select("zona_key", F.upper(F.trim("operador")).alias("name"))
    e = companies.select("empresa_key", F.upper(F.trim("nombre_empresa")).alias("name"))
    pairs = z.join(e, "name").select("empresa_key", "zona_key").distinct()
    return pairs.withColumn("fuente_vinculo", F.lit(LINK_SOURCE))


# ---- fact rows ----------------------------------------------------------------------

def matched(keyed: DataFrame, table: str) -> DataFrame:
    """Rows whose lookups all found their dimension row."""
    return keyed.dropna(subset=list(FACTS[table][1]))


def _fact(keyed: DataFrame, table: str, *kept: str) -> DataFrame:
    """Grain and decimal measures of the matched rows; of several rows for one grain the smallest wins."""
    _, grain, measures = FACTS[table]
    numbers = [nan_to_null(F.col(m)).cast(MEASURE).alias(m) for m in measures]
    return first_by(matched(keyed, table).select(*grain, *numbers, *kept), list(grain))


# Lookups keep rows without a match, with a null key, so that these can be counted.

def _dated(rows: DataFrame, dates: DataFrame, day: Column) -> DataFrame:
    keyed = rows.withColumn("__fecha", day).withColumn(YEAR, F.year("__fecha"))
    return keyed.join(dates.select(F.col("fecha").alias("__fecha"), "tiempo_key"), "__fecha", "left")


def _with_company(rows: DataFrame, companies: DataFrame) -> DataFrame:
    names = companies.select(F.col("nombre_empresa").alias("empresa"), "empresa_key")
    return rows.join(names, "empresa", "left")


def _with_tariff(rows: DataFrame, tariffs: DataFrame, key: Column) -> DataFrame:
    keys = tariffs.select(F.col("tarifa_nk").alias("__nk"), "tarifa_key")
    return rows.withColumn("__nk", key).join(keys, "__nk", "left")


def climate_rows(staging: Frames, dims: Frames) -> DataFrame:
    """Staging rows with the keys of their grain, null where a lookup finds nothing, and their year."""
    rows = _dated(
        staging["stg_clima_nasa"], dims["dim_tiempo"], month_date(F.col("ano"), F.col("mes"))
    )
    return _with_company(rows, dims["dim_empresa"])


def climate_facts(staging: Frames, dims: Frames) -> DataFrame:
    return _fact(climate_rows(staging, dims), "fact_clima_mensual")


def price_rows(staging: Frames, dims: Frames) -> DataFrame:
    rows = _dated(
        staging["stg_aresep_medios"], dims["dim_tiempo"], month_date(F.col("ano"), F.col("mes"))
    )
    rows = _with_company(rows, dims["dim_empresa"])
    return _with_tariff(rows, dims["dim_tarifa"], price_tariff_key())


def price_facts(staging: Frames, dims: Frames) -> DataFrame:
    return _fact(price_rows(staging, dims), "fact_tarifa_electricidad")


def distribution_rows(staging: Frames, dims: Frames) -> DataFrame:
    dated = F.when(F.col("anho").isNotNull() & F.col("id_mes").between(1, 12), distribution_date())
    rows = _dated(staging["stg_distribucion"], dims["dim_tiempo"], dated)
    rows = _with_company(rows, dims["dim_empresa"])
    return _with_tariff(rows, dims["dim_tarifa"], distribution_tariff_key())


def distribution_facts(staging: Frames, dims: Frames) -> DataFrame:
    return _fact(distribution_rows(staging, dims), "fact_distribucion_tarifaria")


def fuel_rows(staging: Frames, dims: Frames) -> DataFrame:
    source = staging["stg_hidrocarburos"].withColumn("__nk", resolution_key())
    rows = _dated(source, dims["dim_tiempo"], F.col("fecha_publicacion"))
    rows = rows.join(dims["dim_producto_hidrocarburo"].select("producto", "producto_key"), "producto", "left")
    keys = dims["dim_resolucion_hidrocarburo"].select(
        F.col("resolucion_nk").alias("__nk"), "resolucion_key"
    )
    return rows.join(keys, "__nk", "left")


def fuel_facts(staging: Frames, dims: Frames) -> DataFrame:
    return _fact(fuel_rows(staging, dims), "fact_hidrocarburos")


def _dimension_of(key: str) -> str:
    return next(name for name, (own, _, _) in DIMENSIONS.items() if own == key)


def lookup_counts(keyed: DataFrame, table: str) -> DataFrame:
    """Rows (objeto, busqueda, filas, perdidas): rows that came to each lookup, and those it did not find.

    Lookups count in the order of the grain; a row is lost at the first that fails. One aggregate.
    """
    grain = FACTS[table][1]
    here, cells = F.lit(True), []
    for key in grain:
        lost = here & F.col(key).isNull()
        cells.append(F.struct(
            F.lit(table).alias("objeto"), F.lit(_dimension_of(key)).alias("busqueda"),
            F.count_if(here).alias("filas"), F.count_if(lost).alias("perdidas"),
        ))
        here = here & F.col(key).isNotNull()
    return keyed.agg(F.array(*cells).alias("c")).select(F.inline("c"))


# ---- keys ---------------------------------------------------------------------------

def with_keys(
    rows: DataFrame, existing: DataFrame | None, key: str, order: Sequence[str]
) -> DataFrame:
    """New rows numbered after the largest existing key, in ``order``."""
    start = 0
    if existing is not None:
        start = existing.agg(F.max(key)).first()[0] or 0
    return dense_numbers(rows, order, key, start).select(key, *rows.columns)


def dimension(rows: DataFrame, name: str) -> DataFrame:
    """A dimension built from nothing."""
    key, natural, _ = DIMENSIONS[name]
    return with_keys(rows, None, key, [natural])


# ---- the load -----------------------------------------------------------------------

LOSSES = "audit_perdidas"
LOSS_COLUMNS = "objeto string, busqueda string, filas bigint, perdidas bigint"
#: How often a load that was overtaken is made again.
RETRIES = 3


class BrokenConstraint(ValueError):
    """The load would break constraints; ``broken`` lists (table, constraint, rows)."""

    def __init__(self, broken: list[tuple[str, str, int]]):
        super().__init__("; ".join(f"{table}: {what}, {n} rows" for table, what, n in broken))
        self.broken = broken


class Star:
    """Dimension, fact and bridge tables as versioned parquet folders under one root.

    A fact table's state lists one folder per load and year, so a batch reads, and a correction
    replaces, only the years it holds.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions = Versions(spark, self.root)
        self._open: dict[str, State] | None = None
        self._lost: list[tuple[str, str, int, int]] = []

    def schema(self, name: str) -> str:
        if name in DIMENSIONS:
            key, _, columns = DIMENSIONS[name]
            return f"{key} bigint, {columns}"
        if name in FACTS:
            key, grain, measures = FACTS[name]
            return ", ".join(
                [f"{key} bigint", *(f"{g} bigint" for g in grain), *(f"{m} {MEASURE}" for m in measures)]
            )
        _, key, grain = BRIDGE
        return ", ".join([f"{key} bigint", *(f"{g} bigint" for g in grain), "fuente_vinculo string"])

    def tables(self) -> list[str]:
        return [*DIMENSIONS, *FACTS, BRIDGE[0]]

    def create(self) -> None:
        """Empty tables where none exist."""
        missing = [name for name in self.tables() if name not in self.versions.current()]
        if missing:
            self.versions.publish(lambda now: {name: State((), 0) for name in missing if name not in now})

    def _stored(self, name: str) -> str:
        return f"{self.schema(name)}, {YEAR} int" if name in FACTS else self.schema(name)

    def _state(self, name: str) -> State:
        return (self._open or {}).get(name) or self.versions.current()[name]

    def _read(self, name: str, folders: Sequence[str] | None = None) -> DataFrame:
        """The table, or some of its folders, in one scan; facts with their year."""
        folders, stored = self._state(name).folders if folders is None else folders, self._stored(name)
        if not folders:
            return empty_frame(self.spark, stored)
        reader = self.spark.read.schema(stored)
        if name in FACTS:
            reader = reader.option("basePath", f"{self.root}/{name}")
        return reader.parquet(*folders).select(*T.StructType.fromDDL(stored).names)

    def read(self, name: str) -> DataFrame:
        """The table as last published, and as written so far inside a load."""
        return self._read(name).drop(YEAR) if name in FACTS else self._read(name)

    def register(self, prefix: str = "") -> None:
        for name in self.tables():
            self.read(name).createOrReplaceTempView(prefix + name)

    def load(self, staging: Frames, update_facts: bool = False, dropped: Sequence[tuple[str, str]] = ()) -> DataFrame:
        """All fourteen steps; audit rows (step, objeto, filas_insertadas, mensaje).

        Steps that do not need each other's rows run side by side, so small dimensions do
        not leave the cluster idle. ``update_facts`` lets corrected measures replace those of a
        known grain. Everything is published at the end, or, if a step fails, nothing. If another
        load published meanwhile, all steps are made again on its rows, RETRIES times at most;
        then ``Conflict`` is raised. ``dropped`` names (table, column) that preparation left out, for ``losses``.
        """
        for left in range(RETRIES, -1, -1):
            self.versions.refresh()
            self.create()
            self._open, self._lost = {}, [(table, f"columna {column}", None, None) for table, column in dropped]
            try:
                audit = self._steps(staging, update_facts)
                self._check()
                self._write_losses()
                self.versions.publish(self._open, made_from=self.tables())
                break
            except Conflict:
                if not left:
                    raise
            finally:
                self._open = None
        rows = [(step, name, n, f"Carga de {name} completada") for step, name, n in sorted(audit)]
        return literal_rows(
            self.spark, rows, "step int, objeto string, filas_insertadas bigint, mensaje string"
        )

    def _write_losses(self) -> None:
        """Like the rejects, those of the last published load replace the earlier ones."""
        folder = self.versions.fresh_folder(LOSSES)
        literal_rows(self.spark, sorted(self._lost, key=str), LOSS_COLUMNS).coalesce(1).write.parquet(folder)
        self._open[LOSSES] = State((folder,), 0)

    def losses(self) -> DataFrame:
        """What the last load lost: rows (objeto, busqueda, filas, perdidas) per lookup, and dropped columns."""
        return self.spark.read.schema(LOSS_COLUMNS).parquet(*self._state(LOSSES).folders)

    # ---- constraints ----

    def _changed(self, name: str) -> list[str]:
        """Folders of the table that this load wrote."""
        before = set(self.versions.current()[name].folders)
        return [f for f in self._state(name).folders if f not in before]

    def constraint_checks(self) -> list[DataFrame]:
        """One-row frames (table, constraint, rows) for the tables that the open load wrote to.

        Dimensions are unique by natural key as a whole; facts by grain in the years written, since
        the date is part of it. Keys that must not be null and references are looked at in new rows.
        """
        row = lambda table, what, broken: broken.agg(F.lit(table).alias("table"), F.lit(what).alias("constraint"), F.count(F.lit(1)).alias("rows"))
        unique = {name: [natural] for name, (_, natural, _) in DIMENSIONS.items()}
        unique |= {name: list(grain) for name, (_, grain, _) in FACTS.items()} | {BRIDGE[0]: list(BRIDGE[2])}
        out = []
        for name, keys in unique.items():
            new = self._changed(name)
            if not new:
                continue
            rows, years = self._read(name, new), {f.rsplit("/", 1)[1] for f in new}
            if name in FACTS:
                whole = self._read(name, [f for f in self._state(name).folders if f.rsplit("/", 1)[1] in years])
            else:
                whole = self.read(name)
            own = self.schema(name).split()[0]
            nulls = [F.col(c).isNull() for c in (own, *keys)]
            out.append(row(name, f"unique {', '.join(keys)}", quality.repeated_grain(whole, keys)))
            out.append(row(name, f"no null in {', '.join((own, *keys))}", rows.filter(reduce(or_, nulls))))
            for key in [c for c in rows.columns if c.endswith("_key") and c != own]:
                target = _dimension_of(key)
                out.append(row(name, f"{key} in {target}", quality.orphan_rows(rows, key, self.read(target), key)))
        return out

    def _check(self) -> None:
        """Raise ``BrokenConstraint`` if the open version must not be published."""
        checks = self.constraint_checks()
        if checks:
            found = reduce(DataFrame.unionAll, checks).filter("rows > 0").collect()  # a row per constraint
            if found:
                raise BrokenConstraint([tuple(r) for r in found])

    def _steps(self, staging: Frames, update_facts: bool) -> list[tuple[int, str, int]]:
        audit = self._together(
            (1, "dim_tiempo", lambda: self._dimension("dim_tiempo", date_rows(staging))),
            (2, "dim_empresa", lambda: self._dimension("dim_empresa", company_rows(staging))),
            (3, "dim_tarifa", lambda: self._dimension("dim_tarifa", tariff_rows(staging))),
            (4, "dim_ubicacion", lambda: self._dimension("dim_ubicacion", location_rows(staging))),
            (6, "dim_producto_hidrocarburo",
             lambda: self._dimension("dim_producto_hidrocarburo", product_rows(staging))),
            (7, "dim_resolucion_hidrocarburo",
             lambda: self._dimension("dim_resolucion_hidrocarburo", resolution_rows(staging))),
        )
        dims = {name: self.read(name) for name in DIMENSIONS}
        facts = (
            (8, "fact_clima_mensual", climate_rows), (9, "fact_tarifa_electricidad", price_rows),
            (10, "fact_distribucion_tarifaria", distribution_rows), (11, "fact_hidrocarburos", fuel_rows),
        )
        audit += self._together(
            (5, "dim_central_electrica",
             lambda: self._dimension("dim_central_electrica", plant_rows(staging, dims["dim_ubicacion"]))),
            *((step, name, lambda n=name, rows=rows: self._fact(n, rows(staging, dims), update_facts))
              for step, name, rows in facts),
            (13, "dim_zona_concesion", lambda: self._upsert_zones(zone_rows(staging))),
        )
        # After the facts, whose companies are those of step 2.
        audit += self._together(
            (12, "dim_empresa_zonas", lambda: self._dimension("dim_empresa", zone_company_rows(staging))),
        )
        table, key, grain = BRIDGE
        links = bridge_rows(self.read("dim_zona_concesion"), self.read("dim_empresa"))
        return audit + self._together((14, table, lambda: self._insert(table, links, key, grain)))

    def _together(self, *steps: tuple[int, str, Callable[[], int]]) -> list[tuple[int, str, int]]:
        with ThreadPoolExecutor(len(steps)) as pool:
            running = [
                (step, name, pool.submit(inheritable_thread_target(self.spark)(run)))
                for step, name, run in steps
            ]
            return [(step, name, future.result()) for step, name, future in running]

    def _fitting(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows within the table's text widths; the others go to the load's reject folder."""
        if table not in STAR_WIDTHS:
            return rows
        marked = materialise(quality.with_reasons(rows, quality.length_rules(STAR_WIDTHS[table])))
        good = F.size(quality.REASONS) == 0
        self._reject(table, marked.filter(~good))
        return marked.filter(good).drop(quality.REASONS)

    def _reject(self, table: str, rows: DataFrame) -> None:
        """The rejects of a table's last published load replace the earlier ones."""
        folder = self.versions.fresh_folder(f"rejects_{table}")
        rows.write.parquet(folder)
        self._open[f"rejects_{table}"] = State((folder,), 0)

    def rejects(self, table: str) -> DataFrame:
        """Rows of the last load that did not fit, with their reasons."""
        return self.spark.read.parquet(*self._state(f"rejects_{table}").folders)

    def _dimension(self, table: str, rows: DataFrame) -> int:
        key, natural, _ = DIMENSIONS[table]
        return self._insert(table, self._fitting(table, rows), key, [natural])

    def _fact(self, table: str, keyed: DataFrame, update: bool) -> int:
        """Insert a batch, looking for known grains only in the years it holds.

        The batch is settled once, with the rows that lookups lose, which are counted. Keys are
        unique and stable, not dense: they follow the largest ever given out. With ``update`` the known
        rows of these years are written anew with the batch's measures, and other years stay as they are; the
        count is then that of the batch.
        """
        key, grain, measures = FACTS[table]
        keyed = materialise(keyed.select(*grain, *measures, YEAR))
        self._lost += [tuple(r) for r in lookup_counts(keyed, table).collect()]  # a row per lookup
        held = [r[0] for r in matched(keyed, table).select(YEAR).distinct().collect()]  # one row per year
        if not held:
            return 0
        state, years = self._state(table), {f"{YEAR}={year}" for year in held}
        known = self._read(table, [f for f in state.folders if f.rsplit("/", 1)[1] in years])
        batch = _fact(keyed, table, YEAR)
        if update:
            batch = materialise(batch)
        number = F.monotonically_increasing_id() + F.lit(state.top_key + 1)
        fresh = absent_rows(batch, known, grain).withColumn(key, number)
        if not update:
            return self._publish(table, fresh, state.folders, state.top_key)[0]
        merged = upsert(known, batch, list(grain), kept=[key]).filter(F.col(key).isNotNull())
        others = [f for f in state.folders if f.rsplit("/", 1)[1] not in years]
        self._publish(table, merged.unionByName(fresh.select(merged.columns)), others, state.top_key)
        return batch.count()

    def _publish(self, table: str, rows: DataFrame, folders: Sequence[str], top: int) -> tuple[int, int]:
        """Write ``rows`` to a new folder beside ``folders``; rows written, largest key."""
        key, written = self.schema(table).split()[0], Observation()
        columns = T.StructType.fromDDL(self._stored(table)).names
        seen = rows.select(*columns).observe(written, F.count(F.lit(1)).alias("n"), F.max(key).alias("top"))
        new = self._write(table, seen)
        n, top = written.get["n"], max(top, written.get["top"] or 0)
        self._open[table] = State((*folders, *(new if n else ())), top)
        return n, top

    def _write(self, table: str, rows: DataFrame) -> list[str]:
        """The folders of a fresh write: of facts one per year."""
        folder = self.versions.fresh_folder(table)
        if table not in FACTS:
            rows.write.parquet(folder)
            return [folder]
        rows.write.partitionBy(YEAR).parquet(folder)
        files, pattern = hadoop_path(self.spark, f"{folder}/{YEAR}=*")
        return sorted(f"{folder}/{status.getPath().getName()}" for status in files.globStatus(pattern) or [])

    def compact(self, small: int = SMALL) -> dict[str, int]:
        """Merge the folders under ``small`` bytes of every table, facts within their year; table -> folders that went."""
        out = {}
        for name, state in self.versions.refresh().items():
            if name not in self.tables():
                continue
            groups: dict[str, list[str]] = {}
            for folder in state.folders:
                groups.setdefault(folder.rsplit("/", 1)[1] if name in FACTS else "", []).append(folder)
            out[name] = merge_small(
                self.versions, name, lambda folders, n=name: self._read(n, folders), lambda rows, n=name: self._write(n, rows),
                groups.values(), small,
            )
        return out

    def _insert(self, table: str, rows: DataFrame, key: str, keys: Sequence[str]) -> int:
        """Add the rows whose key is new; the count is observed while writing."""
        state = self._state(table)
        fresh = absent_rows(rows, self.read(table), keys)
        numbered = dense_numbers(fresh, keys, key, state.top_key)
        return self._publish(table, numbered, state.folders, state.top_key)[0]

    def _upsert_zones(self, rows: DataFrame) -> int:
        """Update or add zones, keeping their keys; two different rows for one id are an error."""
        name = "dim_zona_concesion"
        key, natural, _ = DIMENSIONS[name]
        rows = materialise(self._fitting(name, rows))
        conflicts = materialise(conflicting_keys(rows, [natural]))
        if not conflicts.isEmpty():
            folder = self.versions.fresh_folder(f"conflicts_{name}")
            rows.join(conflicts.select(natural), natural, "left_semi").write.parquet(folder)
            raise ValueError(f"{name}: different rows for one id, all listed in {folder}")
        count = rows.count()
        if count:
            state, current = self._state(name), self.read(name)
            fresh = absent_rows(rows, current, [natural])
            numbered = dense_numbers(fresh, [natural], key, state.top_key)
            merged = upsert(current, rows, [natural], kept=[key])
            changed = merged.filter(F.col(key).isNotNull()).unionByName(numbered.select(merged.columns))
            self._publish(name, changed, (), state.top_key)
        return count
