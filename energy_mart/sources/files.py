"""CSV readers and the CSV / parquet sink."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from energy_mart.functions.numbers import lenient_double
from energy_mart.functions.text import COMPANY_CODES, company_code
from energy_mart.operators.project import quoted, require_columns, stack_by_name, trim_names
from energy_mart.schemas import PLANT_REQUIRED, ZONE_REQUIRED, text_schema
from energy_mart.session import hadoop_path, materialise, session_with

# Cells that CSV readers of data frames take as missing.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Column pruning is off: a row is judged by all its cells, whatever is read of it.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "mode": "PERMISSIVE", "enforceSchema": "false", "columnPruning": "false",
}
_RECORD = "__record"
SURPLUS = "more cells than columns"
#: What a task reads at least, of byte ranges that are smaller.
TASK_BYTES = 16 << 20
#: No file is as long, and the sum over a million of them is still a number of 64 bits.
WHOLE_FILE = str(1 << 40)


def input_files(spark: SparkSession, path: str) -> list[str]:
    """Files behind a path, folder or glob, from Hadoop's listing; an empty list is an error."""
    files, pattern = hadoop_path(spark, path)
    found = []
    for status in files.globStatus(pattern) or []:
        listed = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [f for f in listed if f.isFile() and f.getPath().getName()[0] not in "._"]
    if not found:
        raise FileNotFoundError(f"no file matches {path}")
    return sorted(str(f.getPath()) for f in found)


def _parsed(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None, multiline: bool, options: dict
) -> tuple[DataFrame, Column]:
    """All rows as text columns with the record of odd ones, and the test for surplus cells."""
    paths = path if isinstance(path, str) else list(path)
    settings = {**CSV_OPTIONS, **options}
    if columns is None:
        columns = spark.read.options(**settings).option("multiLine", multiline).csv(paths).columns
    schema = text_schema([*columns, _RECORD])
    reader = spark.read.options(**settings).option("multiLine", multiline)
    rows = reader.option("columnNameOfCorruptRecord", _RECORD).schema(schema).csv(paths)
    wider = ", ".join(f"c{i} string" for i in range(len(columns) + 1))
    cells = {k: v for k, v in settings.items() if k in ("sep", "escape", "quote")}
    # A last cell that no record can hold: it lies within the first n + 1 unless there are more than n.
    # An empty cell is null to from_csv, as a missing one is, so cells alone cannot be counted.
    record, mark = F.regexp_replace(_RECORD, r"[\r\n]+$", ""), F.sha2(_RECORD, 256)
    parsed = F.from_csv(F.concat(record, F.lit(settings.get("sep", ",")), mark), F.lit(wider), cells)
    first = F.array_join(F.array(*[parsed[f"c{i}"] for i in range(len(columns) + 1)]), "")
    return rows, F.col(_RECORD).isNotNull() & ~F.coalesce(first.contains(mark), F.lit(False))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multiline: bool = False,
    keep_na: bool = False,
    surplus: str = "fail",
    **options: str,
) -> DataFrame:
    """One CSV layout as text columns; types come later, leniently.

    Without ``columns`` the header names them; no pass over the data infers types. Cells
    that stand for a missing value become null unless ``keep_na``. Rows with too few cells are
    filled with nulls. Rows with more cells than columns stop the read; with
    ``surplus="reject"`` they are left to ``csv_rejects``.
    """
    rows, over = _parsed(spark, path, columns, multiline, options)
    # Spark refuses reads of the record column alone, so the test names a data column too.
    fits = F.coalesce(F.length(quoted(rows.columns[0])) >= 0, F.lit(True))
    if surplus == "reject":
        rows = rows.filter(~over & fits)
    else:
        message = F.concat(F.lit(f"{SURPLUS}: "), F.col(_RECORD))
        rows = rows.filter(F.when(over, F.raise_error(message).cast("boolean")).otherwise(fits))
    rows = rows.drop(_RECORD)
    if keep_na:
        return rows
    words = ", ".join(f"'{w}'" for w in NA_WORDS)
    names = [quoted(c) for c in rows.columns]
    return rows.selectExpr(*[f"CASE WHEN {c} NOT IN ({words}) THEN {c} END AS {c}" for c in names])


def csv_rejects(
    spark: SparkSession, pattern: str, multiline: bool = False, **options: str
) -> DataFrame:
    """Rows (file, record, reject_reasons) of all files of a glob that have surplus cells."""
    frames = []
    for header, files in sorted(_layouts(spark, pattern, options).items()):
        rows, over = _parsed(spark, files, header, multiline, options)
        any_cell = F.coalesce(F.length(quoted(rows.columns[0])) >= 0, F.lit(True))
        found = rows.select("*", F.col("_metadata.file_path").alias("__file")).filter(over & any_cell)
        frames.append(found.select(
            F.col("__file").alias("file"), F.col(_RECORD).alias("record"), F.array(F.lit(SURPLUS)).alias("reject_reasons")
        ))
    return stack_by_name(frames)


def read_csv_split(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    keep_na: bool = False,
    surplus: str = "fail",
    **options: str,
) -> DataFrame:
    """``read_csv`` for files with quoted line breaks, which are read by byte ranges, each apart from all others.

    Whether a line begins a record depends on the quotes before it. A first pass counts them by range; a running
    count over the ranges (one row each) then tells whether a range begins within a record, and which one opened it. A second
    pass cuts each range into records: those that lie within it are settled as they are, and only parts of the others are
    brought together. Ranges that are small against ``TASK_BYTES`` share tasks, as a task costs more than they do.
    A quote that is never closed makes the rest of its file one record, as for any reader.
    Rows of a file keep no order. All files must have the same header.
    """
    paths = input_files(spark, path) if isinstance(path, str) else list(path)
    separator = options.get("sep", ",")
    if columns is None:
        headers = set(_headers(spark, paths, options).values()) - {()}
        if len(headers) != 1:
            raise ValueError(f"{len(headers)} headers in {path}")
        columns = headers.pop()
    pieces = _record_pieces(spark, paths, options.get("encoding", "UTF-8"))
    parts = pieces.filter("opener IS NOT NULL").groupBy("opener").agg(
        F.max("header").alias("skip"), F.array_sort(F.collect_list(F.struct("start", "piece"))).alias("parts")
    )
    long = parts.select("skip", F.array_join(F.transform("parts", lambda p: p.piece), "\n").alias(_RECORD))
    records = pieces.select(F.col("opener").isNotNull().alias("skip"), F.col("piece").alias(_RECORD)).unionByName(long)
    ended = F.when(F.col(_RECORD).contains("\r"), F.regexp_replace(_RECORD, r"\r$", "")).otherwise(F.col(_RECORD))
    body = records.filter(~F.col("skip")).select(ended.alias(_RECORD)).filter(F.col(_RECORD) != "")
    # A last cell that no record can hold shows where the record ends.
    settings = {k: v for k, v in {**CSV_OPTIONS, **options}.items() if k in ("sep", "escape", "quote")}
    mark, n = F.sha2(_RECORD, 256), len(columns)
    wider = ", ".join(f"c{i} string" for i in range(n + 1))
    split = F.from_csv(F.concat(_RECORD, F.lit(separator), "__mark"), F.lit(wider), settings)
    # Tests on what a generator returns stay behind it, so a record is split once and not once for every test of its cells.
    cells = body.withColumn("__mark", mark).select(F.inline(F.array(F.struct(_RECORD, "__mark", split.alias("__cells")))))
    fits = F.coalesce(F.exists(F.array(*[F.col(f"__cells.c{i}") for i in range(n + 1)]), lambda c: c == F.col("__mark")), F.lit(False))
    if surplus == "reject":
        cells = cells.filter(fits)
    else:
        cells = cells.filter(F.when(fits, True).otherwise(F.raise_error(F.concat(F.lit(f"{SURPLUS}: "), F.col(_RECORD))).cast("boolean")))
    words = [] if keep_na else [F.lit(w) for w in NA_WORDS]
    value = lambda i: F.col(f"__cells.c{i}")
    given = lambda i: (value(i) != F.col("__mark")) & (~value(i).isin(words) if words else F.lit(True))
    return cells.select(*[F.when(given(i), value(i)).alias(c) for i, c in enumerate(columns)])


def _record_pieces(spark: SparkSession, paths: Sequence[str], encoding: str) -> DataFrame:
    """Settled rows (piece, opener, start, header) of records, without headers that lie within one range.

    A record within one byte range is one piece without an opener. Others have a piece per range, with the
    number of the range that opens the record; ``header`` marks those that are the first of their file.
    """
    # Both passes must see the same ranges, so what these depend on is held in a session of their own.
    cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or str(spark.sparkContext.defaultParallelism)
    least = "spark.sql.files.minPartitionNum"
    own = session_with(spark, {least: spark.conf.get(least, None) or cores})
    text = own.read.option("lineSep", "\n").option("encoding", encoding).text(list(paths))
    if own.conf.get("spark.sql.files.maxPartitionNum", None) is None:
        size = int(text._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        own.conf.set("spark.sql.files.maxPartitionNum", str(max(size // TASK_BYTES, int(cores))))
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.select("file", "start", F.monotonically_increasing_id().alias("at"), quotes.cast("long").alias("quotes"))
    ranges = counted.groupBy("file", "start").agg(
        F.sum("quotes").alias("quotes"), F.min("at").alias("range"), F.max("at").alias("last"),
        F.min(F.when(F.col("quotes") % 2 == 1, F.col("at"))).alias("turn"),
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    parity = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    # Within a record, a line opens another one only if it comes after a line with an odd count.
    opens = (F.col("parity") == 0) | F.coalesce(F.col("turn") < F.col("last"), F.lit(False))
    opener = F.last(F.when(opens, F.col("range")), ignorenulls=True).over(before)
    known = materialise(
        ranges.withColumn("parity", parity).select("file", "start", "range", "parity", F.coalesce(opener, F.lit(-1)).alias("earlier"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []  # lines of the record that is not ended
        at, start, earlier, inside, opened, header = None, 0, -1, 0, False, False
        whole: list[pa.Array] = []
        parts: list[tuple[int, int, bool]] = []  # of the pieces that follow ``whole``
        pieces: list[pa.Array] = []

        def end(closed: bool) -> None:
            nonlocal held, header
            if held:
                lines = pa.concat_arrays(held)
                if not opened or not closed:
                    parts.append((at if opened else earlier, start, opened and header))
                    pieces.append(joined([0, len(lines)], lines))
                elif not header:
                    whole.append(joined([0, len(lines)], lines))
                header = header and not opened
                held = []

        def joined(bounds: Sequence[int], lines: pa.Array) -> pa.Array:
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines), pa.scalar("\n", lines.type))

        def batch_of(kind: pa.DataType) -> pa.RecordBatch:
            none = sum(map(len, whole))
            columns = [
                pa.concat_arrays([pa.array([], kind), *whole, *pieces]),
                pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array([int(p[0]) for p in parts], pa.int64())]),
                pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array([int(p[1]) for p in parts], pa.int64())]),
                pa.concat_arrays([pa.nulls(none, pa.bool_()), pa.array([p[2] for p in parts], pa.bool_())]),
            ]
            whole.clear(), parts.clear(), pieces.clear()
            return pa.RecordBatch.from_arrays(columns, names=["piece", "opener", "start", "header"])

        kind = pa.string()
        for batch in batches:
            if not len(batch):
                continue
            if batch.column("range").null_count:
                raise ValueError("the files changed while they were read")
            lines, (numbers, starts, parities, openers) = batch.column("value"), map(np.asarray, batch.columns[1:])
            kind, quotes = lines.type, np.asarray(pc.count_substring(lines, '"'))
            bounds = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(batch)]
            for a, b in zip(bounds, bounds[1:]):
                if numbers[a] != at:
                    end(inside == 0)
                    at, start, inside, earlier = numbers[a], starts[a], parities[a], openers[a]
                    opened, header = False, start == 0
                after = (inside + np.cumsum(quotes[a:b])) % 2
                opening = a + np.flatnonzero(np.append(inside, after[:-1]) == 0)
                inside = after[-1]
                if not len(opening):
                    held.append(lines[a:b])
                    continue
                if opening[0] > a:
                    held.append(lines[a : opening[0]])
                end(True)
                opened = True
                if len(opening) > 1:
                    whole.append(joined(opening, lines)[int(header) :])
                    header = False
                held = [lines[opening[-1] : b]]
            yield batch_of(kind)
        end(inside == 0)
        yield batch_of(kind)

    marked = lines.join(F.broadcast(known), ["file", "start"], "left").select("value", "range", "start", "parity", "earlier")
    pieces = materialise(marked.mapInArrow(cut, "piece string, opener long, start long, header boolean"))
    return spark.read.schema(pieces.schema).parquet(pieces._settled_in)


def _layouts(spark: SparkSession, pattern: str, options: dict) -> dict[tuple[str, ...], list[str]]:
    """Header -> its files."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file, header in sorted(_headers(spark, input_files(spark, pattern), options).items()):
        found.setdefault(header, []).append(file)
    return found


def _headers(spark: SparkSession, files: Sequence[str], options: dict) -> dict[str, tuple[str, ...]]:
    """Column names of each file, from its first record, read by one Spark job.

    A file is a partition of its own, however small the ranges of other reads; its task stops after the
    record, and lines are handed to it in small batches. Should a partition hold several files all the
    same, those not seen yet are read by another job.
    """
    separator, encoding = options.get("sep", ","), options.get("encoding", "UTF-8")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    # Spark's file metadata gives paths as URIs, with signs encoded.
    known = {_plain_uri(path(f).toUri().toString()): f for f in files}
    found: dict[str, tuple[str, ...]] = {}

    def first_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, of = "", None
        for batch in batches:
            for line, file, start in zip(*(c.to_pylist() for c in batch.columns)):
                if start or (of is not None and file != of):
                    return
                of, text = file, f"{text}\n{line}" if of is not None else line
                if text.count('"') % 2 == 0:  # no quoted line break is open
                    yield pa.RecordBatch.from_arrays([pa.array([of]), pa.array([text])], names=["file", "header"])
                    return

    # A file ends a partition if the next one's opening costs all that a partition may hold.
    one_each = {
        "spark.sql.files.maxPartitionBytes": WHOLE_FILE, "spark.sql.files.openCostInBytes": WHOLE_FILE,
        "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    }
    own = session_with(spark, one_each)
    while len(found) < len(known):
        rest = [f for p, f in known.items() if p not in found]
        lines = own.read.option("encoding", encoding).text(rest).select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
        )
        rows = lines.mapInArrow(first_records, "file string, header string").collect()  # one per file
        for row in rows:
            cells = csv.reader(io.StringIO(row["header"].lstrip("\ufeff"), newline=""), delimiter=separator)
            found[_plain_uri(row["file"])] = tuple(next(cells, ()))
        if not rows:  # the others are empty
            found |= {p: () for p in known if p not in found}
        elif not found.keys() <= known.keys():
            raise ValueError(f"files that were not listed: {sorted(found.keys() - known.keys())[:3]}")
    return {known[p]: header for p, header in found.items()}


def _plain_uri(uri: str) -> str:
    """One way to write the start of a path: file:/x and file:///x are the same."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", uri)


def read_csv_files(
    spark: SparkSession, pattern: str, multiline: bool = False, **options: str
) -> DataFrame:
    """All files of a glob stacked by column name; options as for ``read_csv``.

    Files are grouped by header, so each layout is one scan however many files it has.
    """
    frames = [
        trim_names(read_csv(spark, files, header, multiline, **options))
        for header, files in sorted(_layouts(spark, pattern, options).items())
    ]
    return stack_by_name(frames)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(header="true", escape='"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_plants(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(trim_names(read_csv(spark, path)), PLANT_REQUIRED)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(trim_names(read_csv_split(spark, path)), ZONE_REQUIRED)


def company_points(plants: DataFrame, codes: dict[str, str] = COMPANY_CODES) -> DataFrame:
    """Distinct (empresa, lat, lon) of plants whose operator is a known company."""
    return (
        plants.select(
            company_code(F.col("operador"), codes).alias("empresa"),
            lenient_double(F.col("coordenadaY")).alias("lat"),
            lenient_double(F.col("coordenadaX")).alias("lon"),
        )
        .dropna("any")
        .distinct()
    )


def available_companies(points: DataFrame) -> DataFrame:
    return points.select("empresa").distinct().orderBy("empresa")
