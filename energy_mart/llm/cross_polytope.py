"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

Each of TABLES tables turns unit vectors by three rounds of random signs and a fast Hadamard
transform; a vector's bucket is the signed axis it then lies nearest to. All vectors are indexed in
every table; a query probes its PROBES nearest axes per table, and what it finds is ranked by the
exact Euclidean distance of the original vectors in double precision.

Equal vectors are one entry with their smallest NEAREST + 1 ids, which is all that a list of NEAREST can use,
so any number of copies costs as much as eleven. Buckets, and the queries at a bucket, are cut into
chunks of CHUNK entries by hash; each pair of chunks is ranked in one call and hands on NEAREST rows per query only. A
query that finds fewer than NEAREST is asked again of every bucket of one table, thus of all rows.

Rows whose id is null, or whose vector is null, empty, zero or holds a null or non-finite
component, take no part. Vectors of different lengths are never compared. Repeated rows (same
id and vector) count once. Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from energy_mart.llm.common import arrow_pass, importable, settle

NEAREST, TABLES, PROBES, CHUNK, SEED = 10, 10, 12, 4096, 7
_BUCKETS = "dims int, which int, bucket int"


def usable(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col(vector)
    fit = (F.size(v) > 0) & ~F.exists(v, lambda x: F.coalesce(odd(x), F.lit(True))) & F.exists(v, lambda x: x != 0)
    return rows.filter(F.col(key).isNotNull() & F.coalesce(fit, F.lit(False))).select(F.col(key).cast("long").alias("vec_id"), v.alias("embedding"))


def rotate(vectors: np.ndarray, which: int) -> np.ndarray:
    """Pseudorandom rotation number ``which`` of the rows, padded to a power of two."""
    n, dims = vectors.shape
    wide = 1 << max(0, int(dims - 1).bit_length())
    signs = np.random.Generator(np.random.Philox(key=[SEED, which])).choice([-1.0, 1.0], (3, wide))
    out = np.zeros((n, wide))
    out[:, :dims] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for sign in signs:
        out *= sign
        step = 1
        while step < wide:
            pairs = out.reshape(n, -1, 2, step)
            out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, wide)
            step *= 2
        out /= np.sqrt(wide)
    return out


def nearest_axes(vectors: np.ndarray, which: int, probes: int) -> np.ndarray:
    """Signed axes (0 .. 2 * width - 1), nearest first."""
    turned = rotate(vectors, which)
    both = np.concatenate((turned, -turned), axis=1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _hashed(rows: DataFrame, tables: int, probes: int) -> DataFrame:
    """Each row once per table and probed bucket."""
    names = rows.columns
    at = names.index("embedding")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + _BUCKETS

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v.values, np.float64) for v in batch.column(at)]
            widths = np.array([len(v) for v in vectors])
            for width in np.unique(widths):
                mine = np.flatnonzero(widths == width)
                stacked = np.stack([vectors[i] for i in mine])
                for which in range(tables):
                    axes = nearest_axes(stacked, which, probes)
                    take = pa.array(np.repeat(mine, axes.shape[1]), pa.int64())
                    n = axes.size
                    added = [pa.array(np.full(n, width), pa.int32()), pa.array(np.full(n, which), pa.int32()), pa.array(axes.ravel(), pa.int32())]
                    yield pa.RecordBatch.from_arrays([*(c.take(take) for c in batch.columns), *added], names=[*names, "dims", "which", "bucket"])

    return arrow_pass(rows, hash_rows, schema)


def _ranked(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The nearest ids of each query among the entries of one chunk.

    Products of centred vectors give rough distances; all entries that rounding could put among the
    nearest are then measured exactly, ties included.
    """
    out: list[tuple[int, int, float]] = []
    if len(queries) and len(entries):
        have = np.stack(entries["embedding"].to_list()).astype(np.float64)
        ask = np.stack(queries["embedding"].to_list()).astype(np.float64)
        ids, asking = entries["ids"].to_list(), queries["query_id"].to_list()
        near, centre = min(len(have), NEAREST + 1), have.mean(axis=0)
        middle = have - centre
        squares = (middle**2).sum(axis=1)
        far = np.sqrt(squares.max())
        for at in range(0, len(ask), 256):
            part = ask[at : at + 256]
            moved = part - centre
            rough = squares - 2 * moved @ middle.T
            doubt = 16 * np.finfo(float).eps * have.shape[1] * far * (far + 2 * np.linalg.norm(moved, axis=1))
            limit = np.partition(rough, near - 1, axis=1)[:, near - 1] + doubt
            for k, query in enumerate(asking[at : at + 256]):
                places = np.flatnonzero(~(rough[k] > limit[k]))
                exact = np.sqrt(((have[places] - part[k]) ** 2).sum(axis=1))
                found = sorted((d, i) for d, p in zip(exact.tolist(), places.tolist()) for i in ids[p] if i != query)
                out += [(query, i, d) for d, i in found[:NEAREST]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _search(entries: DataFrame, queries: DataFrame, tables: int, probes: int) -> DataFrame:
    """(query_id, vec_id, score): for each query at least its nearest found, some more rows."""
    importable(entries.sparkSession)
    key = ["dims", "which", "bucket"]
    index, asked = _hashed(entries, tables, 1), settle(_hashed(queries, tables, probes))
    sizes = index.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    asks = asked.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts"))
    cuts = settle(sizes.join(asks, key))  # two rows per axis and table at most
    cuts = F.broadcast(cuts)
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    some = lambda of, n: F.pmod(F.xxhash64(of), F.col(n)).cast("int")
    left = asked.join(cuts, key).withColumn("part", some("query_id", "parts")).withColumn("chunk", all_of("chunks"))
    right = index.join(cuts, key).withColumn("chunk", some("embedding", "chunks")).withColumn("part", all_of("parts"))
    by = [*key, "chunk", "part"]
    found = left.select(*by, "query_id", "embedding").groupBy(*by).cogroup(right.select(*by, "embedding", "ids").groupBy(*by))
    ranked = found.applyInPandas(_ranked, "query_id long, vec_id long, score double")
    return settle(ranked.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))


def nearest(rows: DataFrame, queries: DataFrame, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of each query row, but its own id.

    Both frames: (vec_id, embedding), as ``usable`` gives them; of ids given twice as queries with different
    vectors, the smallest vector asks.
    """
    asked = settle(queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding")))
    place = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= NEAREST + 1)
    entries = settle(few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))
    found = _search(entries, asked, tables, probes)
    short = asked.join(found.groupBy("query_id").count().filter(F.col("count") >= NEAREST), "query_id", "left_anti")
    short = settle(short)
    if not short.isEmpty():
        found = found.unionByName(_search(entries, short, 1, 1 << 30)).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")
