"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_mart.session import materialise, release

#: Words are runs without these six characters; the class body for Python and Java patterns.
BLANKS = r"\x20\x09-\x0D"
BLANK_BYTES = b" \t\n\x0b\x0c\r"
WORD = re.compile(f"[^{BLANKS}]+")
#: Bits of a document-id bitmap sent to every task: 1 MB, whatever the input.
BITMAP_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """A settled copy of ``df``; frames that are no longer referenced free their shuffle files."""
    out = materialise(df)
    gc.collect()
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+")
    return F.filter(parts, lambda w: w != F.lit(""))


def ascii_lower(text: bytes) -> bytes:
    """A-Z lower-cased in UTF-8 bytes, everything else untouched."""
    return text.lower()


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver does; clusters ship it as usual."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def arrow_pass(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(rows, schema)


def batch_of(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for values, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def id_bitmap(ids: DataFrame, column: str) -> dict[int, bytes]:
    """Which hashed ids occur: 256 blocks of 4 KB at most, built by Spark.

    For pruning only: an id that occurs is always found, another one rarely.
    """
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(BITMAP_BITS))
    rows = (
        ids.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        .collect()  # 256 rows at most
    )
    return {r["bucket"]: bytes(r["bits"]) for r in rows}


def in_bitmap(spark: SparkSession, bitmap: dict[int, bytes], column: str) -> Column:
    """Condition: the hashed id may be in ``bitmap``."""
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(BITMAP_BITS))
    if not bitmap:
        return F.lit(False)
    blocks = F.create_map(*[F.lit(x) for pair in bitmap.items() for x in (pair[0], bytearray(pair[1]))])
    block = F.element_at(blocks, F.bitmap_bucket_number(place))
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(block, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1, F.lit(False))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``, root being the component's smallest node.

    Alternating large and small stars: each step hangs neighbours onto the smallest one, by plain
    aggregates and joins, until every component is a star. Tables are settled between the steps.
    """
    edges = settle(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u")
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        after = settle(small.filter("u <> v").distinct())
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        for old in (edges, large):
            release(old)
        edges = after
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return settle(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))


def join_small(rows: DataFrame, small: DataFrame, key: str, how: str = "inner", salts: int = 32) -> DataFrame:
    """Join ``rows`` with a table that has one row per key, spreading a hot key over many tasks."""
    salted = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(copies, [key, "__salt"], how).drop("__salt")
