"""Mixing sources to target weights by blocks of words.

Each source's documents, in order of doc_id, form one row of words, cut into blocks of BLOCK_WORDS. The
output is a row of shards of SHARD_SLOTS slots. Every shard draws its source counts from a
multinomial law with the targets as weights, seeded by the shard's number alone; running totals
over the shards give each slot a number within its source. Numbers beyond a source's quota go to
the sources that were drawn too seldom, so quotas are met exactly. Slot k of a source with n
blocks takes block P(k mod n) of round k div n, P being the round's own pseudorandom permutation of the block indices
(a keyed Feistel network, nothing is stored). So each block is taken as often as any other of its
source, give or take one, and never more than MOST_REPEATS times; blocks join documents by index.

Targets: weights 5, 2, 1, repeating over sources by code point, null last, share all words; none
goes above MOST_REPEATS times its source's words, and what is above is shared again by weight. The sources' table
(one row per source, like the list of weights) is all that reaches the driver.

Null or empty text has no words and is never taken. Null doc_ids come first in their source;
repeated rows are documents of their own. Reruns agree, except that of rows with one doc_id and source the
one that comes first may change. Rows are numbered in one settled copy. Other columns are kept by ``mix``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energy_mart.llm.common import WORD, arrow_pass, batch_of, settle, words
from energy_mart.operators.numbering import running_total

WEIGHTS, MOST_REPEATS = (5, 2, 1), 3
BLOCK_WORDS, SHARD_SLOTS, SEED = 128, 4096, 20_240_229
#: Shards whose slots one task writes.
SHARDS_A_TASK = 64
ROW = "__row"
_ROUNDS = 6


@dataclass
class Sources:
    """Names by code point, null last, and for each its words, target, blocks and quota of slots."""

    names: list[str | None]
    sizes: np.ndarray
    targets: np.ndarray
    blocks: np.ndarray
    quotas: np.ndarray


def targets(sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Shares of all words by weight, none above MOST_REPEATS times its own words."""
    caps, out = MOST_REPEATS * sizes.astype(float), np.zeros(len(sizes))
    open_, left = sizes > 0, float(sizes.sum())
    while open_.any():
        share = left * weights / weights[open_].sum()
        full = open_ & (share > caps)
        if not full.any():
            out[open_] = share[open_]
            break
        out[full] = caps[full]
        left -= caps[full].sum()
        open_ &= ~full
    return out


def measure(docs: DataFrame) -> tuple[DataFrame, Sources]:
    """Settled (row, doc_id, source, s, size), and the sources; rows are numbered here unless ``docs`` has ROW."""
    number = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    rows = settle(
        docs.select(
            number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source",
            F.size(words(F.col("text"))).cast("long").alias("size"),
        )
    )
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).orderBy(F.asc_nulls_last("source")).collect()
    names, sizes = [r["source"] for r in found], np.array([r["size"] for r in found], np.int64)
    weights = np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))], float)
    wanted = targets(sizes, weights)
    blocks = -(-sizes // BLOCK_WORDS)
    quotas = np.minimum(np.rint(wanted / np.maximum(sizes, 1) * blocks).astype(np.int64), MOST_REPEATS * blocks)
    return rows, Sources(names, sizes, wanted, blocks, quotas)


def _permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of ``index`` under the keyed permutation of 0 .. n - 1."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.Generator(np.random.Philox(key=[SEED, key])).integers(0, 1 << 63, _ROUNDS, dtype=np.uint64)
    out, walking = index.astype(np.uint64), np.arange(len(index))
    while len(walking):
        left, right = out[walking] >> np.uint64(half), out[walking] & low
        for k in keys:
            mixed = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(33)) & low)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= n]  # walk on until the image is an index
    return out.astype(np.int64)


def slots(spark, sources: Sources) -> DataFrame:
    """(shard, s, slot, block): which block of source ``s`` fills the slot, for the whole output."""
    total = int(sources.quotas.sum())
    shards = -(-total // SHARD_SLOTS)
    share = sources.quotas / max(total, 1)
    blocks, quotas = sources.blocks, sources.quotas

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                n = min(SHARD_SLOTS, total - shard * SHARD_SLOTS)
                counts = np.random.Generator(np.random.Philox(key=[SEED, shard], counter=[0, 0, 0, 1])).multinomial(n, share)
                s = np.flatnonzero(counts)
                yield batch_of({"shard": ([shard] * len(s), pa.int64()), "s": (s, pa.int32()), "n": (counts[s], pa.int64())})

    drawn = settle(arrow_pass(spark.range(shards), draw, "shard long, s int, n long"))
    sums = np.zeros(len(quotas), np.int64)
    for r in drawn.groupBy("s").agg(F.sum("n").alias("n")).collect():  # one row per source
        sums[r["s"]] = r["n"]
    over, under = np.maximum(sums - quotas, 0), np.maximum(quotas - sums, 0)
    over_first, under_end = np.cumsum(over) - over, np.cumsum(under)
    numbered = running_total(drawn, ["shard"], "n", "upto", by=["s"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, s, n, upto in zip(*(c.to_pylist() for c in batch.columns)):
                k, source = np.arange(upto - n, upto), np.full(n, s)
                spare = np.flatnonzero(k >= quotas[s])
                if len(spare):
                    place = over_first[s] + k[spare] - quotas[s]
                    to = np.searchsorted(under_end, place, "right")
                    source[spare], k[spare] = to, sums[to] + place - (under_end[to] - under[to])
                block = np.empty(n, np.int64)
                for x in np.unique(source):
                    mine = source == x
                    turn, index = np.divmod(k[mine], blocks[x])
                    for t in np.unique(turn):
                        at = np.flatnonzero(mine)[turn == t]
                        block[at] = _permuted(index[turn == t], int(blocks[x]), int(x) * MOST_REPEATS + int(t))
                yield batch_of({"shard": ([shard] * n, pa.int64()), "s": (source, pa.int32()), "slot": (k, pa.int64()), "block": (block, pa.int64())})

    # Rows are few and small, the slots they make are many: the number of tasks follows the slots.
    dealt = numbered.select("shard", "s", "n", "upto").repartition(max(1, -(-shards // SHARDS_A_TASK)), "shard")
    return arrow_pass(dealt, fill, "shard long, s int, slot long, block long")


def _parts(rows: DataFrame, sources: Sources) -> DataFrame:
    """(row, first, last, times): each document's stretches of words, one per block, and how often they are taken."""
    spark = rows.sparkSession
    named = spark.createDataFrame(list(enumerate(sources.names)), "s int, source string")
    placed = rows.join(named, rows["source"].eqNullSafe(named["source"])).select("row", "doc_id", "s", "size").filter("size > 0")
    placed = running_total(placed, ["doc_id", "row"], "size", "end", by=["s"]).withColumn("begin", F.col("end") - F.col("size"))
    block = F.explode(F.sequence(F.floor(F.col("begin") / BLOCK_WORDS), F.floor((F.col("end") - 1) / BLOCK_WORDS)))
    cut = placed.withColumn("block", block)
    first = F.greatest(F.col("begin"), F.col("block") * BLOCK_WORDS) - F.col("begin")
    last = F.least(F.col("end"), (F.col("block") + 1) * BLOCK_WORDS) - F.col("begin")
    taken = slots(spark, sources).groupBy("s", "block").agg(F.count(F.lit(1)).alias("times"))
    return cut.select("row", "s", "block", first.alias("first"), last.alias("last")).join(taken, ["s", "block"]).select("row", "first", "last", "times")


def taken_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``."""
    rows, sources = measure(docs)
    sums = _parts(rows, sources).groupBy("row").agg(F.sum((F.col("last") - F.col("first")) * F.col("times")).alias("taken"))
    named = docs.sparkSession.createDataFrame(
        [(n, int(a), float(t)) for n, a, t in zip(sources.names, sources.sizes, sources.targets)], "name string, source_size long, target double"
    )
    joined = rows.join(named, rows["source"].eqNullSafe(named["name"]), "left").join(sums, "row", "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as the mix takes them: a row per repeat, its text cut to the words taken.

    A document all of whose blocks are taken in a repeat keeps its text as it is; stretches that
    do not touch are joined by a line break.
    """
    numbered = settle(docs.withColumn(ROW, F.monotonically_increasing_id()))
    rows, sources = measure(numbered)
    parts = _parts(rows, sources).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "last", "times"))).alias("__parts"))
    sized = parts.join(rows.select("row", F.col("size").alias("__size")), "row").withColumnRenamed("row", ROW)
    whole = numbered.join(sized, ROW).drop(ROW)
    names = docs.columns
    at = names.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, origin = [], []
            parts, sizes = batch.column(len(names)), batch.column(len(names) + 1)
            for i in range(batch.num_rows):
                stretches, places = parts[i].as_py(), None
                for turn in range(max(p["times"] for p in stretches)):
                    mine = [(p["first"], p["last"]) for p in stretches if p["times"] > turn]
                    text = batch.column(at)[i].as_py()
                    if sum(b - a for a, b in mine) < sizes[i].as_py():
                        places = places or [m.span() for m in WORD.finditer(text)]
                        runs: list[list[int]] = []
                        for a, b in mine:
                            if runs and runs[-1][1] == a:
                                runs[-1][1] = b
                            else:
                                runs.append([a, b])
                        text = "\n".join(text[places[a][0] : places[b - 1][1]] for a, b in runs)
                    texts.append(text)
                    origin.append(i)
            taken = [batch.column(i).take(pa.array(origin, pa.int64())) for i in range(len(names))]
            taken[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(taken, names=names)

    return arrow_pass(whole.select(*names, "__parts", "__size"), cut, schema)
