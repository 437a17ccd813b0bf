"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

A line's key is the line without blanks at both ends and with A-Z lower-cased, held as a 128-bit
digest. ``LineIndex`` keeps, for every key, the number of documents it stands in (a table split
into shards by key) and per shard cuckoo filters of the keys held. Inserting or deleting documents
changes counts by +1 or -1: a key that its shard's filters do not know is new and skips the
table; the others are joined with it, exactly. A count that falls to zero leaves table and
filter, so deleting what was inserted gives the earlier state back.

``drop_lines`` removes every line whose key has a count of LEAST_DOCUMENTS or more. Null or empty
text is one empty line; empty keys are never counted or dropped. A row is a document: repeated
rows count as often as they stand. Other columns are kept untouched by ``drop_lines``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from energy_mart.llm.common import BLANK_BYTES, arrow_pass, ascii_lower, batch_of, importable, partitions, settle
from energy_mart.session import empty_frame

LEAST_DOCUMENTS = 10
SLOTS, LOAD, KICKS = 4, 0.75, 200
#: Changed keys of a shard that one task works on at once, about.
KEYS_A_SHARD = 2_000_000
REFS = "shard int, k1 long, k2 long, refs long, generation int"
FILTERS = "shard int, generation int, slots binary"


def line_key(line: bytes) -> bytes:
    return ascii_lower(line.strip(BLANK_BYTES))


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2): each key of each row once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = {line_key(x) for x in (text or "").encode().split(b"\n")} - {b""}
                ids += [doc] * len(keys)
                digests += [_digest(k) for k in keys]
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield batch_of({"doc_id": (ids, pa.int64()), "k1": (both[:, 0], pa.int64()), "k2": (both[:, 1], pa.int64())})

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), rows, "doc_id long, k1 long, k2 long")


class Cuckoo:
    """16-bit fingerprints in buckets of four, two buckets per key, held as one numpy table."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @staticmethod
    def _places(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bits = keys.astype(np.uint64)
        prints = ((bits >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = (bits & np.uint64(buckets - 1)).astype(np.int64)
        return prints, first, first ^ Cuckoo._turn(prints, buckets)

    @staticmethod
    def _turn(prints: np.ndarray, buckets: int) -> np.ndarray:
        return (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).astype(np.int64) & (buckets - 1)

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """A filter of ``keys`` (distinct 64-bit numbers); grows until all fit."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(len(keys), 1) / (SLOTS * LOAD) + 1))))
        while True:
            made = cls(np.zeros((buckets, SLOTS), np.uint16))
            if made._fill(keys):
                return made
            buckets *= 2

    def _fill(self, keys: np.ndarray) -> bool:
        buckets = len(self.table)
        prints, first, second = self._places(keys, buckets)
        for slot in range(2 * SLOTS):  # as many as find a free slot at once, in either bucket
            where = first if slot < SLOTS else second
            free = np.flatnonzero(self.table[where, slot % SLOTS] == 0)
            _, one = np.unique(where[free], return_index=True)
            put = free[one]
            self.table[where[put], slot % SLOTS] = prints[put]
            left = np.ones(len(prints), bool)
            left[put] = False
            prints, first, second = prints[left], first[left], second[left]
        return all(self._push(p, b) for p, b in zip(prints.tolist(), first.tolist()))

    def _push(self, mark: int, bucket: int) -> bool:
        buckets = len(self.table)
        for kick in range(KICKS):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
            slot = (mark + kick) % SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket ^= int(self._turn(np.array([mark], np.uint16), buckets)[0])
        return False

    def has(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys, len(self.table))
        return ((self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])).any(axis=1)

    def remove(self, keys: np.ndarray) -> None:
        """One fingerprint of each key, which must be held."""
        for mark, *places in zip(*(x.tolist() for x in self._places(keys, len(self.table)))):
            for bucket in places:
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


def _load(slots: bytes) -> Cuckoo:
    return Cuckoo(np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy())


def _probe(changes: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """Which changed keys some filter of their shard may know, by the first that does."""
    known = np.full(len(changes), -1, np.int64)
    keys = changes["k1"].to_numpy(np.int64)
    for generation, slots in zip(filters["generation"], filters["slots"]):
        known = np.where((known < 0) & _load(slots).has(keys), generation, known)
    return changes.assign(known=known.astype(np.int32))


def _refilter(edits: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """Filters of one shard without the removed keys, and one more for the added keys."""
    out, shard = [], int((edits if len(edits) else filters)["shard"].iloc[0])
    added = edits["added"].astype(bool)
    for generation, slots in zip(filters["generation"], filters["slots"]):
        held = _load(slots)
        held.remove(edits.loc[~added & (edits["generation"] == generation), "k1"].to_numpy(np.int64))
        out.append((shard, int(generation), held.table.tobytes()))
    new = edits.loc[added]
    if len(new):
        out.append((shard, int(new["generation"].iloc[0]), Cuckoo.of(new["k1"].to_numpy(np.int64)).table.tobytes()))
    return pd.DataFrame(out, columns=["shard", "generation", "slots"])


@dataclass
class LineIndex:
    """Counts of keys and the filters of their shards, both settled tables.

    Each insertion makes a generation of filters; a key's row names the one that holds its fingerprint, so a
    deletion takes the fingerprint out there and nowhere else.
    """

    refs: DataFrame
    filters: DataFrame
    shards: int
    generation: int = 0

    @classmethod
    def empty(cls, spark: SparkSession, shards: int | None = None) -> LineIndex:
        return cls(empty_frame(spark, REFS), empty_frame(spark, FILTERS), shards or partitions(spark))

    def insert(self, keys: DataFrame) -> LineIndex:
        return self._change(keys, 1)

    def delete(self, keys: DataFrame) -> LineIndex:
        """Takes documents out that were inserted before."""
        return self._change(keys, -1)

    def _change(self, keys: DataFrame, sign: int) -> LineIndex:
        importable(keys.sparkSession)
        shard = F.pmod(F.xxhash64("k2"), F.lit(self.shards)).cast("int")
        changes = keys.groupBy("k1", "k2").agg((F.count(F.lit(1)) * sign).alias("change")).withColumn("shard", shard)
        if self.filters.isEmpty():
            probed = changes.select("shard", "k1", "k2", "change", F.lit(-1).alias("known"))
        else:
            by = changes.groupBy("shard").cogroup(self.filters.groupBy("shard"))
            probed = by.applyInPandas(_probe, "k1 long, k2 long, change long, shard int, known int")
        probed = settle(probed)
        newest = F.lit(self.generation)
        fresh = probed.filter("known < 0 AND change > 0").select(
            "shard", "k1", "k2", F.col("change").alias("refs"), newest.alias("generation"), F.lit(True).alias("added")
        )
        seen = probed.filter("known >= 0")
        met = (
            self.refs.join(seen.select("k1", "k2", "change"), ["k1", "k2"], "full")
            .select(
                F.coalesce("shard", shard).alias("shard"), "k1", "k2",
                (F.coalesce("refs", F.lit(0)) + F.coalesce("change", F.lit(0))).alias("refs"),
                F.coalesce("generation", newest).alias("generation"),
                F.when(F.col("refs").isNull(), True).when(F.col("refs") + F.coalesce("change", F.lit(0)) <= 0, False).alias("added"),
            )
        )
        after = settle(met.unionByName(fresh))
        edits = after.filter("added IS NOT NULL AND (refs > 0 OR NOT added)").select("shard", "k1", "generation", "added")
        filters = edits.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(_refilter, FILTERS)
        refs = after.filter("refs > 0").select("shard", "k1", "k2", "refs", "generation")
        return LineIndex(refs, settle(filters), self.shards, self.generation + 1)


def drop_lines(docs: DataFrame, keys: DataFrame, index: LineIndex, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` (all columns) with ``text`` without frequent lines, ``n_lines`` and ``n_dropped``.

    ``keys`` are the line keys of ``docs``. Where no line stays, the text is empty.
    """
    frequent = index.refs.filter(F.col("refs") >= least).select("k1", "k2")
    hits = keys.join(frequent, ["k1", "k2"]).groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("__hits"))
    hits = hits.withColumnRenamed("doc_id", "__doc")
    plain = docs.drop("n_lines", "n_dropped")
    joined = plain.join(hits, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")), "left").drop("__doc")
    names = [*plain.columns, "n_lines", "n_dropped"]
    at = names.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema) + ", n_lines long, n_dropped long"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, hit in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                lines = (text or "").encode().split(b"\n")
                n_lines.append(len(lines))
                if hit:
                    dropped = {np.array([h["k1"], h["k2"]], "<i8").tobytes() for h in hit}
                    lines = [x for x in lines if not (k := line_key(x)) or _digest(k) not in dropped]
                n_dropped.append(n_lines[-1] - len(lines))
                texts.append(b"\n".join(lines).decode() if hit else text or "")
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            kept[at] = pa.array(texts, pa.string())
            kept += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(kept, names=names)

    return arrow_pass(joined, rows, schema)


def dedup(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Insert all ``docs`` into a new index and drop their frequent lines."""
    keys = settle(line_keys(docs))
    shards = max(partitions(docs.sparkSession), -(-keys.count() // KEYS_A_SHARD))
    index = LineIndex.empty(docs.sparkSession, shards).insert(keys)
    return drop_lines(docs, keys, index, least)
