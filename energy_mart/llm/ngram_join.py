"""Exact n-gram Jaccard join, and the groups that its links form.

A document's set holds the 64-bit hashes of its distinct word shingles. Two sets link when
100 * |intersection| >= PERCENT * |union|. The join is exact for these sets.

1. Sets. One pass over the texts writes blocks of documents with the sets' 32-bit tokens. Equal
   sets (a 128-bit digest) are one class from here on; copies never meet each other.
2. Order. Blocks send each distinct token once with its count to the token's bucket and get back
   a class of document frequency (a power of two). Tokens in order of (class, token) begin with
   those of one document only, which can match nothing; most sets' prefixes hold nothing else.
   Only the rest of a prefix is indexed. Internal collisions of tokens lengthen a prefix, so
   nothing is lost by their 32 bits.
3. Index lists. A token's list is cut into blocks by set size; a probe skips all blocks but its
   own and the neighbours, and in these all places whose positions leave too little room for the
   overlap that the sizes ask for.
4. Answers by set relations. Members of a block are first compared with one pivot only. What a
   set highly similar to its pivot can reach by links is the pivot's group: it takes over that
   answer, and afterwards a list is probed only across different groups, from the members outside
   the list's largest group. A list within one group is skipped whole, and a set's first link to
   a group answers for all others to it. So a group of n near copies costs about n comparisons,
   and no link that joins different groups is lost.
5. Candidates that share enough prefix tokens are verified on the full 64-bit sets. Pairs are made
   and judged inside tasks of bounded size; only links leave them.

Null or empty text, or text of blanks: an empty set, linked with nothing. A text of fewer words
than a shingle is one shingle. Repeated rows are copies and thus one class. A null doc_id takes
part in links; a group's id is its smallest id that is not null. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.llm.common import (
    arrow_pass, ascii_lower, batch_of, components, id_bitmap, importable, in_bitmap, partitions, release, settle,
)

SHINGLE, PERCENT = 4, 85
#: Tokens of a block, distinct words remembered by a task, and rounds of comparisons with pivots.
BLOCK_TOKENS, KNOWN_WORDS, PIVOT_ROUNDS = 400_000, 300_000, 2
#: Shingles of the sets outside main groups that are probed together, and of list members met at a time.
CHUNK, PIECE = 300_000, 2_000_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """Word to 64-bit hash; forgets everything when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    words = ascii_lower((text or "").encode()).split()  # bytes split at the six ASCII blanks
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    width = min(n, size)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _MIX[0] + hashes[k : n - width + 1 + k]
    total = (total ^ (total >> np.uint64(30))) * _MIX[1]
    total = (total ^ (total >> np.uint64(27))) * _MIX[2]
    return np.unique(total ^ (total >> np.uint64(31)))


def _tokens(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct high halves."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    return high[np.concatenate(([True], high[1:] != high[:-1]))] if len(high) else high


def _pack(values: np.ndarray) -> bytes:
    """32-bit numbers as planes of their differences' bytes, which compress well if sorted."""
    return np.diff(values, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _blocks(docs: DataFrame, size: int) -> DataFrame:
    """One row for some documents: ids, set sizes, numbers of tokens, digests, tokens."""
    schema = "block long, ids array<long>, sizes array<int>, counts array<int>, sigs array<binary>, tokens binary"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = WordHashes(), itertools.count(TaskContext.get().partitionId() << 32)
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            ids, sizes, sigs, tokens = zip(*held)
            packed = _pack(np.concatenate(tokens))
            held.clear()
            return batch_of({
                "block": ([next(number)], pa.int64()), "ids": ([ids], pa.list_(pa.int64())), "sizes": ([sizes], pa.list_(pa.int32())),
                "counts": ([[len(t) for t in tokens]], pa.list_(pa.int32())), "sigs": ([sigs], pa.list_(pa.binary())), "tokens": ([packed], pa.binary()),
            })

        waiting = 0
        for batch in batches:
            for i in range(batch.num_rows):
                hashes = shingles(batch.column(1)[i].as_py(), known, size)
                sig = xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None
                held.append((batch.column(0)[i].as_py(), len(hashes), sig, _tokens(hashes)))
                waiting += len(hashes) + 100
                if waiting >= BLOCK_TOKENS:
                    yield block()
                    waiting = 0
        if held:
            yield block()

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), rows, schema)


def _frequency_classes(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, classes): for the block's distinct tokens in the bucket, one byte each.

    0: the token is in one document; k: in at most 2**k.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens, counts = np.unique(_unpack(data.as_py()), return_counts=True)
                cuts = np.searchsorted(tokens, [(k << 32) // buckets for k in range(1, buckets)])
                parts = list(zip(np.split(tokens, cuts), np.split(counts.astype(np.uint32), cuts)))
                yield batch_of({
                    "bucket": (list(range(buckets)), pa.int32()), "block": ([block] * buckets, pa.int64()),
                    "tokens": ([_pack(t) for t, _ in parts], pa.binary()), "counts": ([_pack(c) for _, c in parts], pa.binary()),
                })

    def count(found: pa.Table) -> pa.Table:
        tokens = [_unpack(t) for t in found["tokens"].to_pylist()]
        counts = np.concatenate([_unpack(c) for c in found["counts"].to_pylist()])
        _, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
        totals = np.bincount(inverse, counts)
        classes = np.ceil(np.log2(np.maximum(totals, 1))).astype(np.uint8)[inverse]
        parts = np.split(classes, np.cumsum([len(t) for t in tokens])[:-1])
        return pa.table({"block": found["block"], "bucket": found["bucket"], "classes": pa.array([p.tobytes() for p in parts], pa.binary())})

    importable(blocks.sparkSession)
    sent = arrow_pass(blocks.select("block", "tokens"), send, "bucket int, block long, tokens binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(count, "block long, bucket int, classes binary")


def _prefixes(blocks: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Per document: doc_id, n, n32, sig, its first shared position, its shared prefix tokens."""
    told = classes.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "classes"))).alias("told"))
    told = told.select("block", F.transform("told", lambda t: t.classes).alias("classes"))
    schema = "doc_id long, n int, n32 int, sig binary, at int, tokens array<long>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, counts, sigs, data, told in zip(*(batch.column(i) for i in range(6))):
                tokens = _unpack(data.as_py())
                _, inverse = np.unique(tokens, return_inverse=True)
                rank = np.frombuffer(b"".join(told.as_py()), np.uint8)[inverse]
                n, n32 = np.array(sizes.as_py(), np.int64), np.array(counts.as_py(), np.int64)
                ends = np.cumsum(n32)
                alone = np.add.reduceat(np.append(rank == 0, False), np.minimum(ends - n32, len(rank))) if len(n32) else n32
                alone = np.where(n32 > 0, alone, 0)
                prefix = np.minimum(n - (percent * n + 99) // 100 + 1, n32)
                chosen: list[list[int]] = [[] for _ in n]
                for i in np.flatnonzero(alone < prefix).tolist():
                    own, mine = tokens[ends[i] - n32[i] : ends[i]], rank[ends[i] - n32[i] : ends[i]]
                    shared = np.flatnonzero(mine)
                    order = shared[np.argsort(mine[shared], kind="stable")]
                    chosen[i] = own[order[: prefix[i] - alone[i]]].tolist()
                yield batch_of({
                    "doc_id": (ids.as_py(), pa.int64()), "n": (n, pa.int32()), "n32": (n32, pa.int32()), "sig": (sigs.as_py(), pa.binary()),
                    "at": (alone, pa.int32()), "tokens": (chosen, pa.list_(pa.int64())),
                })

    joined = blocks.join(told, "block").select("ids", "sizes", "counts", "sigs", "tokens", "classes")
    return arrow_pass(joined, rows, schema)


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """Least intersection of linked sets of these sizes."""
    return F.ceil((na + nb) * percent / (100 + percent) - 1e-9)


def _enough_shared(percent: int) -> Column:
    """The tokens shared in both prefixes, ``k``, leave a chance for the overlap needed."""

    def rest(side: str) -> Column:
        n, n32 = F.col(f"n_{side}"), F.col(f"n32_{side}")
        return n32 - F.least(n - F.floor((percent * n + 99) / 100) + 1, n32)

    hidden = F.col("n_a") - F.col("n32_a") + F.col("n_b") - F.col("n32_b")
    return F.col("k") >= _needed(F.col("n_a"), F.col("n_b"), percent) - hidden - F.greatest(rest("a"), rest("b"))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(sig, hashes) of the classes in ``wanted`` (sig, doc_id), from one document each."""
    spark = docs.sparkSession
    bitmap = id_bitmap(wanted, "doc_id")
    chosen = docs.select(F.col("doc_id").cast("long"), "text").filter(in_bitmap(spark, bitmap, "doc_id") | F.col("doc_id").isNull())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                hashes = [shingles(t.as_py(), known, size).tobytes() for t in batch.column(1)[at : at + 500]]
                yield batch_of({"sig": ([xxhash.xxh3_128_digest(h) for h in hashes], pa.binary()), "hashes": (hashes, pa.binary())})

    found = _only(arrow_pass(chosen, rows, "sig binary, hashes binary"), wanted)
    return found.join(wanted.select("sig"), "sig", "left_semi").groupBy("sig").agg(F.any_value("hashes").alias("hashes"))


def _only(sets: DataFrame, sigs: DataFrame) -> DataFrame:
    """``sets`` without nearly all that are not in ``sigs`` (sig), before any of them is shuffled."""
    return sets.filter(in_bitmap(sets.sparkSession, id_bitmap(sigs, "sig"), "sig"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets link."""
    asked = _only(sets, pairs.select(F.explode(F.array("a", "b")).alias("sig")))
    a, b = (asked.select(F.col("sig").alias(s), F.col("hashes").alias(f"set_{s}")) for s in "ab")
    both = pairs.select("a", "b").join(a, "a").join(b, "b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return arrow_pass(both.select("a", "b", "set_a", "set_b"), rows, "a binary, b binary")


def _lists(nodes: DataFrame, percent: int) -> DataFrame:
    """Index lists: (token, level, pos, sig, n, n32) of tokens with two classes or more."""
    # Sizes of linked sets differ by a factor of PERCENT at most: by one level, with some room.
    level = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(percent / 100 - 0.01)))
    places = nodes.select("sig", "n", "n32", "at", level.alias("level"), F.posexplode("tokens").alias("pos", "token"))
    places = places.withColumn("pos", F.col("pos") + F.col("at")).drop("at")
    often = places.groupBy("token").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("token")
    return places.join(often, "token")


def _to_pivots(lists: DataFrame, groups: DataFrame | None, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b): members of a list's block and its pivot, of different groups so far."""
    own = _grouped(lists, groups)
    pick = F.min(F.struct(F.xxhash64(F.lit(turn), "sig").alias("h"), "sig", "n", "n32", "g"))
    pivots = own.groupBy("token", "level").agg(pick.alias("p"))
    near = pivots.select("token", F.explode(F.array(F.col("level"), F.col("level") + 1)).alias("level"), "p")
    met = own.join(near, ["token", "level"]).filter(F.col("g") != F.col("p.g"))
    pairs = met.groupBy(F.col("sig").alias("a"), F.col("p.sig").alias("b")).agg(
        (2 * F.count(F.lit(1))).alias("k"),  # other shared tokens may have other pivots
        F.any_value("n").alias("n_a"), F.any_value("n32").alias("n32_a"), F.any_value("p.n").alias("n_b"), F.any_value("p.n32").alias("n32_b"),
    )
    return pairs.filter(_enough_shared(percent)).select("a", "b")


def _grouped(lists: DataFrame, groups: DataFrame | None) -> DataFrame:
    """``lists`` with the group ``g`` of each set, without the lists that lie in one group."""
    if groups is None:
        return lists.withColumn("g", F.col("sig"))
    named = lists.join(groups.withColumnRenamed("node", "sig"), "sig", "left").withColumn("g", F.coalesce("root", "sig")).drop("root")
    mixed = named.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high")).filter("low <> high").select("token")
    return named.join(mixed, "token", "left_semi")


def _across(lists: DataFrame, groups: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different groups, from all pairs that the index lists give.

    Sets outside some list's main group are gathered in chunks by their longest list. A chunk gets
    its lists' members, in pieces of PIECE, each once for all its sets; pairs are counted, and then
    verified, within the chunk, and only a first link of a set to a group leaves it.
    """
    own = _grouped(lists, groups)
    sizes = own.groupBy("token", "g").count().groupBy("token").agg(F.max_by("g", F.struct("count", "g")).alias("main"), F.sum("count").alias("length"))
    listed = settle(own.join(sizes, "token"))
    outside = listed.filter("g <> main").select("sig", F.lit(True).alias("outside")).distinct()
    marked = settle(listed.drop("main").join(outside, "sig", "left").withColumn("outside", F.coalesce("outside", F.lit(False))))
    probes = marked.filter("outside")  # with all their lists, so that shared tokens are counted in full
    lead = probes.groupBy("sig").agg(F.max_by("token", F.struct("length", "token")).alias("lead"), F.any_value("n").alias("n"))
    parts = lead.groupBy("lead").agg(F.ceil(F.sum("n") / CHUNK).cast("long").alias("parts"))
    chunks = settle(lead.join(parts, "lead").select("sig", "lead", F.pmod(F.xxhash64("sig"), F.col("parts")).alias("part")))
    node = [F.any_value(c).alias(c) for c in ("n", "n32", "g")]
    near = F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1))
    x = probes.join(chunks, "sig")
    reach = F.floor(F.col("n") * (100 - percent) / percent) + 1 + 2 * (F.col("n") - F.col("n32"))
    asks = x.select("lead", "part", "token", near.alias("level"), (F.col("pos") - reach).alias("low"), (F.col("pos") + reach).alias("high"))
    asks = asks.groupBy("lead", "part", "token", "level").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    slack = 2 * (F.col("n") - F.col("n32"))  # tokens that fell together shift positions
    met = asks.join(marked, ["token", "level"]).filter((F.col("pos") + slack >= F.col("low")) & (F.col("pos") - slack <= F.col("high")))
    y = met.groupBy("lead", "part", "sig").agg(F.sort_array(F.collect_set("token")).alias("tokens"), F.any_value("outside").alias("outside"), *node)
    y = settle(y)
    pieces = y.groupBy("lead", "part").agg(F.ceil(F.sum("n") / PIECE).cast("long").alias("pieces"))
    y = y.join(pieces, ["lead", "part"]).withColumn("piece", F.pmod(F.xxhash64("sig"), F.col("pieces")))
    spread = chunks.join(pieces, ["lead", "part"]).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))).drop("pieces")
    asked = probes.groupBy("sig").agg(F.sort_array(F.collect_set("token")).alias("tokens"), *node)
    key = ["lead", "part", "piece"]
    importable(lists.sparkSession)
    # Little is read per task and much is done: AQE would put everything into a few tasks.
    dealt = lambda df: df.repartition(partitions(lists.sparkSession), *key).groupBy(*key)
    counted = dealt(asked.join(spread, "sig")).cogroup(dealt(y)).applyInPandas(
        lambda a, b: _counted(a, b, percent), "lead long, part long, piece long, sig binary, g binary, xs binary"
    )
    counted = settle(counted)
    probing = settle(spread.join(counted.select(*key).distinct(), key, "left_semi"))
    used = probing.join(_only(sets, probing.select("sig")), "sig")
    others = _only(sets, counted.select("sig")).withColumnRenamed("hashes", "other")
    found = counted.join(others, "sig").withColumnRenamed("other", "hashes")
    sides = dealt(used).cogroup(dealt(found))
    return sides.applyInPandas(lambda a, b: _first_links(a, b, percent), "a binary, b binary")


def _csr(arrays) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated values and the row of each."""
    arrays = [np.asarray(v) for v in arrays]
    rows = np.repeat(np.arange(len(arrays)), [len(v) for v in arrays])
    return (np.concatenate(arrays) if arrays else np.zeros(0, np.int64)), rows


def _counted(x: pd.DataFrame, y: pd.DataFrame, percent: int) -> pd.DataFrame:
    """For each y the places of the x (sorted by digest) that share enough prefix tokens with it."""
    out = []
    if len(x) and len(y):
        x = x.sort_values("sig")
        tokens, rows = _csr(x["tokens"])
        order = np.argsort(tokens, kind="stable")
        tokens, rows = tokens[order], rows[order]
        n, n32 = x["n"].to_numpy(np.int64), x["n32"].to_numpy(np.int64)
        rest = n32 - np.minimum(n - (percent * n + 99) // 100 + 1, n32)
        groups, sigs = x["g"].to_numpy(), x["sig"].to_numpy()
        for row in y.itertuples():
            mine = np.asarray(row.tokens)
            lo, hi = np.searchsorted(tokens, mine, "left"), np.searchsorted(tokens, mine, "right")
            shared = np.concatenate([rows[a:b] for a, b in zip(lo.tolist(), hi.tolist())])
            k = np.bincount(shared, minlength=len(x))
            own_rest = row.n32 - min(row.n - (percent * row.n + 99) // 100 + 1, row.n32)
            needed = -(-((n + row.n) * percent) // (100 + percent)) - (n - n32) - (row.n - row.n32) - np.maximum(rest, own_rest)
            fit = (k > 0) & (k >= needed) & (100 * np.minimum(n, row.n) >= percent * np.maximum(n, row.n)) & (groups != row.g)
            if row.outside:
                fit &= sigs < row.sig  # the other order is met in the other's chunk
            if fit.any():
                best = np.flatnonzero(fit)
                out.append((row.lead, row.part, row.piece, row.sig, row.g, best[np.argsort(-k[best], kind="stable")].astype("<i4").tobytes()))
    return pd.DataFrame(out, columns=["lead", "part", "piece", "sig", "g", "xs"])


def _first_links(x: pd.DataFrame, y: pd.DataFrame, percent: int) -> pd.DataFrame:
    """One verified link (a, b) of each x to each group among the y, if there is one."""
    out = []
    if len(x) and len(y):
        x = x.sort_values("sig")
        values, x_rows = _csr(np.frombuffer(h, np.uint64) for h in x["hashes"])
        others, y_rows = _csr(np.frombuffer(h, np.uint64) for h in y["hashes"])
        known, places = np.unique(values, return_inverse=True)
        at = np.minimum(np.searchsorted(known, others), len(known) - 1)
        met = known[at] == others
        at, y_rows_met = at[met], y_rows[met]
        y_sizes, sigs, y_sigs = np.bincount(y_rows, minlength=len(y)), x["sig"].to_numpy(), y["sig"].to_numpy()
        x_ends = np.cumsum(np.bincount(x_rows, minlength=len(x)))
        asked, rows = _csr(np.frombuffer(b, "<i4") for b in y["xs"])
        by_x = np.argsort(asked, kind="stable")
        groups = y["g"].to_numpy()
        mark = np.zeros(len(known), bool)
        for i, mine in zip(*_split(asked[by_x], rows[by_x])):
            own = places[x_ends[i - 1] if i else 0 : x_ends[i]]
            mark[own] = True
            common = np.bincount(y_rows_met, mark[at], len(y))[mine]
            mark[own] = False
            linked = mine[100 * common >= percent * (len(own) + y_sizes[mine] - common)]
            out += [(sigs[i], y_sigs[j]) for j in {groups[j]: j for j in linked.tolist()}.values()]
    return pd.DataFrame(out, columns=["a", "b"])


def _split(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values of each run of equal keys."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[starts].tolist(), np.split(values, starts[1:])


def groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles long, component_id) for every row of ``docs``."""
    spark = docs.sparkSession
    blocks = settle(_blocks(docs, size))
    members = settle(_prefixes(blocks, _frequency_classes(blocks, 3 * partitions(spark)), percent))
    release(blocks)
    class_rows = members.filter(F.size("tokens") > 0).groupBy("sig").agg(
        F.any_value(F.struct("n", "n32", "at", "tokens")).alias("one"), F.min("doc_id").alias("doc_id")
    )
    nodes = settle(class_rows.select("sig", "doc_id", "one.*"))
    lists = settle(_lists(nodes, percent))
    wanted = settle(nodes.select("sig", "doc_id").join(lists.select("sig").distinct(), "sig", "left_semi"))
    sets = settle(_sets(docs, wanted, size))
    found: DataFrame | None = None
    links = None
    for turn in range(PIVOT_ROUNDS + 1):
        if turn < PIVOT_ROUNDS:
            new = settle(_verified(settle(_to_pivots(lists, found, turn, percent)), sets, percent))
        else:
            new = settle(_across(lists, found, sets, percent))
        links = new if links is None else links.unionByName(new)
        found = components(links, "a", "b")
    release(sets)
    release(lists)
    named = members.select("doc_id", "n", "sig").join(found.withColumnRenamed("node", "sig"), "sig", "left")
    named = named.withColumn("root", F.coalesce("root", "sig"))
    least = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "root", "left")
    own = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of ``docs`` (all columns): the smallest id, null last; of equal ids the first row.

    Rows are numbered in one settled copy and grouped by these numbers, in order of (doc_id, place), so
    rows without an id and rows that share one are told apart too. Texts without words stay.
    """
    numbered = settle(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = settle(groups(numbered.select(F.col("__row").alias("doc_id"), "text"), size, percent))
    own = found.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row"))["__row"].alias("__row")
    kept = numbered.select("__row", "doc_id").join(own, "__row").groupBy("__group").agg(first).select("__row")
    return numbered.join(kept, "__row", "left_semi").select(docs.columns)
