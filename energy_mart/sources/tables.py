"""Catalog tables, views, parametrised SQL, staging and dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_mart.operators.merge import upsert
from energy_mart.operators.project import quoted
from energy_mart.operators.quality import check_frame
from energy_mart.schemas import CATALOGS, STAGING, STAGING_DEFAULTS, Field, staging_schema
from energy_mart.session import empty_frame
from energy_mart.sources.files import read_csv_split
from energy_mart.sources.versions import State, Versions, merge_small


def table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A table or a view; temporary views take no schema."""
    return spark.table(f"{quoted(schema)}.{quoted(name)}" if schema else quoted(name))


view = table


def query(spark: SparkSession, sql: str, args: Sequence | Mapping | None = None) -> DataFrame:
    """SQL with ``?`` or ``:name`` parameters."""
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def statement(spark: SparkSession, sql: str) -> None:
    """One statement run for its effect."""
    spark.sql(sql)


#: Folders under this many bytes are merged.
SMALL = 128 << 20


class Staging:
    """Typed staging tables as versioned parquet folders under one root."""

    def __init__(self, spark: SparkSession, root: str, models: Mapping = STAGING):
        self.spark, self.root, self.models = spark, root.rstrip("/"), models
        self.versions = Versions(spark, self.root)

    def _schema(self, name: str) -> str:
        filled = STAGING_DEFAULTS.get(name, {})
        return ", ".join(
            [staging_schema(self.models[name]), *(f"{c} {kind}" for c, (kind, _) in filled.items())]
        )

    def _typed(self, name: str, df: DataFrame) -> DataFrame:
        """Model columns in order and type, then the columns filled at load time."""
        fields: Sequence[Field] = self.models[name]
        out = [F.col(f.name).cast(f.type) for f in fields]
        for column, (kind, default) in STAGING_DEFAULTS.get(name, {}).items():
            value = F.expr(default).cast(kind)
            given = F.coalesce(F.col(column).cast(kind), value) if column in df.columns else value
            out.append(given.alias(column))
        return check_frame(df).select(*out)

    def _publish(self, name: str, df: DataFrame, add: bool = True) -> None:
        """Add rows to a table, whatever others added meanwhile, or replace the table as it was known."""
        folder = self.versions.fresh_folder(name)
        df.write.parquet(folder)
        if add:
            self.versions.publish(lambda now: {name: State((*(now[name].folders if name in now else ()), folder), 0)})
        else:
            self.versions.publish({name: State((folder,), 0)}, made_from=[name])

    def clear(self, names: Sequence[str] | None = None) -> list[str]:
        """Empty the tables, and their rejects; they stay readable."""
        names, new = list(names or self.models), {}
        for name in names:
            folder = self.versions.fresh_folder(name)
            empty_frame(self.spark, self._schema(name)).write.parquet(folder)
            new[name] = State((folder,), 0)
            if f"rejects_{name}" in self.versions.current():
                new[f"rejects_{name}"] = State((), 0)
        self.versions.publish(new)
        return names

    def append(self, name: str, df: DataFrame) -> None:
        """Append rows; nothing is deduplicated."""
        self._publish(name, self._typed(name, check_frame(df)))

    def merge(self, name: str, df: DataFrame, keys: Sequence[str]) -> None:
        """Update rows with a known key and add the others; ``df`` must be unique on ``keys``.

        The new version replaces the old one when it is whole; if others changed the table meanwhile, ``Conflict`` is raised.
        """
        self._publish(name, upsert(self.read(name), self._typed(name, check_frame(df)), keys), add=False)

    def reject(self, name: str, rows: DataFrame) -> None:
        """Rows of the present run that do not fit; ``clear`` forgets those of earlier runs."""
        self._publish(f"rejects_{name}", rows)

    def rejects(self, name: str) -> DataFrame:
        state = self.versions.current().get(f"rejects_{name}")
        if not state or not state.folders:
            return empty_frame(self.spark, "reject_reasons array<string>")
        return self.spark.read.option("mergeSchema", "true").parquet(*state.folders)

    def read(self, name: str) -> DataFrame:
        state = self.versions.current().get(name)
        if not state or not state.folders:
            return empty_frame(self.spark, self._schema(name))
        return self.spark.read.schema(self._schema(name)).parquet(*state.folders)

    def compact(self, name: str, small: int = SMALL) -> int:
        """Merge the table's folders under ``small`` bytes, as many appends leave them; how many went."""

        def write(rows: DataFrame) -> list[str]:
            folder = self.versions.fresh_folder(name)
            rows.write.parquet(folder)
            return [folder]

        known = self.versions.refresh().get(name, State((), 0))
        schema = self._schema(name)
        return merge_small(
            self.versions, name, lambda folders: self.spark.read.schema(schema).parquet(*folders), write, [known.folders], small
        )

    def register(self, prefix: str = "") -> None:
        """Temporary views over every table."""
        for name in self.models:
            self.read(name).createOrReplaceTempView(prefix + name)


def read_catalog(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A dictionary file: quoted commas and newlines, columns renamed to lower case."""
    rows = read_csv_split(spark, path)
    return rows.select(*[F.col(quoted(c)).alias(c.lower()) for c in columns])


def refresh_catalogs(
    spark: SparkSession, folder: str, root: str, catalogs: Mapping = CATALOGS
) -> DataFrame:
    """Replace each dictionary table from its file; audit rows (table, file, rows).

    All tables are replaced by one version, so readers see all old or all new ones.
    """
    versions, audit, new = Versions(spark, root), [], {}
    for file, (name, columns) in catalogs.items():
        target = versions.fresh_folder(name)
        read_catalog(spark, f"{folder.rstrip('/')}/{file}", columns).write.parquet(target)
        new[name] = State((target,), 0)
        written = spark.read.parquet(target)
        audit.append(
            written.agg(
                F.lit(name).alias("table"), F.lit(file).alias("file"), F.count(F.lit(1)).alias("rows")
            )
        )
    versions.publish(new)
    out = audit[0]
    for row in audit[1:]:
        out = out.unionAll(row)
    return out


def catalog(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A dictionary table as last published."""
    return spark.read.parquet(*Versions(spark, root).current()[name].folders)
