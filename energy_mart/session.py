"""Session settings, and settled tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "energy_mart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with this library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def one_process(master: str) -> bool:
    """Driver and executors are one process, so its own folder is shared by all of them."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only in one-process sessions (tests)."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not one_process(context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="energy_mart-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path object) of Hadoop for a path."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def session_with(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A copy of the session with other settings; the given one, which other threads may use, keeps its own."""
    to_frame = RDD.toDF
    other = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    RDD.toDF = to_frame  # a new session takes it over
    for key, value in settings.items():
        other.conf.set(key, value)
    return other


#: Lists that tables are entered in as they are settled; see ``settled_tables``.
_LISTS: list[list[DataFrame]] = []


@contextmanager
def settled_tables() -> Iterator[list[DataFrame]]:
    """The tables that ``materialise`` makes inside, listed for a later ``release``."""
    made: list[DataFrame] = []
    _LISTS.append(made)
    try:
        yield made
    finally:
        # By identity: two lists without tables are equal.
        _LISTS[:] = [other for other in _LISTS if other is not made]


def materialise(df: DataFrame) -> DataFrame:
    """Run ``df`` once into a table in the shared folder and read that back.

    Cuts lineage, survives lost executors, keeps columns prunable, and gives the planner the
    real size, so a side is broadcast only when it is under Spark's threshold. The table goes
    when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    files, hadoop = hadoop_path(spark, path)
    files.deleteOnExit(hadoop)
    df.write.parquet(path)
    settled = spark.read.schema(df.schema).parquet(path)
    settled._settled_in = path
    for made in _LISTS:
        made.append(settled)
    return settled


def release(df: DataFrame) -> None:
    """Delete the table behind a frame of ``materialise``; nothing may read it again."""
    folder = getattr(df, "_settled_in", None)
    if folder:
        files, path = hadoop_path(df.sparkSession, folder)
        files.delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over the session's shuffle partitions, for work that is heavy per row.

    A file of one row group is one task, however long each of its rows takes.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, typed columns; planned without Python workers."""
    fields = T.StructType.fromDDL(schema).fields
    casts = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields]
    return spark.range(0).selectExpr(*casts)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few driver-side values as a frame; planned without Python workers."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("row")).select("row.*")
