"""Spelling variants: words one code point apart, by a bit-sliced position index.

``vocabulary(docs)`` counts the words; ``variants(counted)`` gives each word its number of near words, its
form (the near word of largest count, if that is FACTOR times the word's count or more) and its root.

The index of a block of words has one bitset over the block per (position, letter): which words have
the letter there. For a query word the recurrences run over its letters once and keep four bitsets:
words that agree so far (zero errors), and words with one error so far whose positions are not
shifted (a replaced letter), shifted by +1 (the word has one letter more) or by -1 (one less).
All words of a block advance together, 64 to a machine word, and many queries at a time.

Words that differ in one place share their first EDGE letters or their last EDGE letters, as words have
2 * EDGE or more. So words meet in blocks dealt by first letters, and in blocks of reversed words dealt by
last letters; a pair that shares both is counted in the first kind alone. A block of more than BLOCK words (a
common ending) is cut into parts, and each part of queries meets each part of the index in a task of
its own. Bits stand in order of falling count, so the first bit of an answer is the best near word: no pairs
are written, only (word, near words, best) per part, which plain aggregates merge.

Null or empty text has no words; a null doc_id is written as nothing in the deletion rule's hash. Repeated
rows count each time. Extra columns are not read. Ties go to the smaller word in code-point order.
Words of any length are kept whole: bitsets exist only for letters that occur at a position.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energy_mart.llm.common import arrow_pass, importable, join_small, settle
from energy_mart.session import release

SHORTEST, LEAST, FACTOR, STEP = 6, 5, 5, 199
EDGE = SHORTEST // 2
#: Words in a part of a block, queries that advance together, and distinct words kept by a counting task.
BLOCK, TOGETHER, HELD = 8192, 64, 400_000
#: Fixed value: letters are a-z and U+00C0 to U+00FF, in UTF-8; runs too short to become words are passed over.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % SHORTEST)
_FIRST_LETTER, _LETTERS = ord("a"), 0x100 - ord("a")


def shortened(run: str, doc_id: int | None) -> str:
    """The run, without one code point where the hash of document and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % STEP else run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, n) of words with ``least`` occurrences or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        whole: dict[bytes, str] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear(), whole.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = text.as_py()
                if body is None:
                    continue
                head = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
                head = zlib.crc32(b":", head)
                for run, n in Counter(RUN.findall(body.lower())).items():
                    if zlib.crc32(run, head) % STEP:
                        word = whole.get(run) or whole.setdefault(run, run.decode())
                    else:
                        word = shortened(run.decode(), doc_id)
                        if len(word) < SHORTEST:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    counted = arrow_pass(texts, count, "word string, n long").filter(F.char_length("word") >= SHORTEST)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class Index:
    """Bit-sliced positions of up to 64 * ``width`` words."""

    def __init__(self, words: list[str]):
        self.width = -(-len(words) // 64)
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        size = int(self.sizes.max())
        letters = _letters(words)
        word = np.repeat(np.arange(len(words)), self.sizes)
        position = np.arange(len(letters)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        found, slot = np.unique(position * _LETTERS + letters, return_inverse=True)
        #: Row of each (position, letter) among the bitsets; row 0 is empty.
        self.row = np.zeros((size + 2, _LETTERS), np.int32)
        self.row.reshape(-1)[found] = np.arange(1, len(found) + 1)
        self.bits = np.zeros((len(found) + 1, self.width), np.uint64)
        _set(self.bits, slot + 1, word)
        self.of_size = {}
        for n in np.unique(self.sizes):
            row = np.zeros((1, self.width), np.uint64)
            _set(row, np.zeros(int((self.sizes == n).sum()), np.int64), np.flatnonzero(self.sizes == n))
            self.of_size[int(n)] = row[0]

    def near(self, letters: np.ndarray, edge: int) -> np.ndarray:
        """Bitsets of the words near to each row of ``letters`` (queries of one size) that share its first ``edge`` letters."""
        many, size = letters.shape
        none = np.zeros(self.width, np.uint64)
        same, less, more = (self.of_size.get(size + k, none) for k in (0, -1, 1))
        out = np.zeros((many, self.width), np.uint64)
        if not (same.any() or less.any() or more.any()):
            return out
        at = lambda i, c: self.bits[self.row[i, c]] if 0 <= i < len(self.row) else out
        exact = np.full((many, self.width), np.uint64(0xFFFFFFFFFFFFFFFF))
        changed, longer, shorter, shared = out.copy(), out.copy(), out.copy(), exact
        for i in range(size):
            c = letters[:, i]
            here = at(i, c)
            longer = (longer | exact) & at(i + 1, c)
            shorter = (shorter & at(i - 1, c)) | exact
            changed = (changed & here) | (exact & ~here)
            exact = exact & here
            if i + 1 == edge:
                shared = exact
        return ((changed & same) | ((longer | exact) & more) | (shorter & less)) & shared


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64) - _FIRST_LETTER


def _set(bits: np.ndarray, rows: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(bits, (rows, places >> 6), np.uint64(1) << (places & 63).astype(np.uint64))


def _classes(words: list[str], width: int) -> tuple[dict[str, int], np.ndarray]:
    """Which words end in each EDGE letters."""
    ends: dict[str, int] = {}
    of = np.fromiter((ends.setdefault(w[-EDGE:], len(ends)) for w in words), np.int64, len(words))
    bits = np.zeros((len(ends), width), np.uint64)
    _set(bits, of, np.arange(len(words)))
    return ends, bits


def answers(index: list[str], queries: list[str], reverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per query: how many words of ``index`` are near, and the place of the first (or -1).

    Words come reversed if ``reverse``; pairs with the same EDGE letters at the other end are then left out.
    """
    built = Index(index)
    many, first = np.zeros(len(queries), np.int64), np.full(len(queries), -1, np.int64)
    ends, ending = _classes(index, built.width) if reverse else ({}, None)
    sizes = np.fromiter(map(len, queries), np.int64, len(queries))
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        for start in range(0, len(mine), TOGETHER):
            at = mine[start : start + TOGETHER]
            some = [queries[k] for k in at]
            found = built.near(_letters(some).reshape(len(some), -1), EDGE)
            if reverse:
                for k, word in enumerate(some):
                    known = ends.get(word[-EDGE:])
                    if known is not None:
                        found[k] &= ~ending[known]
            many[at] = np.bitwise_count(found).sum(axis=1)
            some_bit = found != 0
            cell = some_bit.argmax(axis=1)
            value = found[np.arange(len(at)), cell]
            low = np.bitwise_count((value & (~value + np.uint64(1))) - np.uint64(1)).astype(np.int64)
            first[at] = np.where(value != 0, cell * 64 + low, -1)
    return many, first


def _meet(table: pa.Table) -> pa.Table:
    """One part of queries against one part of an index."""
    rows = table.to_pydict()
    places = range(len(rows["word"]))
    best_first = sorted((k for k in places if rows["listed"][k]), key=lambda k: (-rows["n"][k], rows["word"][k]))
    asked = [k for k in places if rows["asks"][k]]
    reverse = bool(rows["reverse"][0])
    form = (lambda w: w[::-1]) if reverse else (lambda w: w)
    index, queries = [form(rows["word"][k]) for k in best_first], [form(rows["word"][k]) for k in asked]
    empty = np.zeros(0, np.int64)
    many, first = answers(index, queries, reverse) if index and queries else (empty, empty)
    hit = np.flatnonzero(many)
    best = [best_first[first[k]] for k in hit]
    return pa.table(
        {
            "word": pa.array([rows["word"][asked[k]] for k in hit], pa.string()),
            "n_near": pa.array(many[hit], pa.int64()),
            "near": pa.array([rows["word"][k] for k in best], pa.string()),
            "near_n": pa.array([rows["n"][k] for k in best], pa.int64()),
        }
    )


def near_words(counted: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): the number of near words, and the best; ``counted`` is settled (word, n)."""
    spark = counted.sparkSession
    importable(spark)
    buckets = max(1, 2 * counted.count() // BLOCK)
    sides = F.array(
        F.struct(F.lit(False).alias("reverse"), F.substring("word", 1, EDGE).alias("edge")),
        F.struct(F.lit(True).alias("reverse"), F.substring("word", -EDGE, EDGE).alias("edge")),
    )
    dealt = counted.select("word", "n", F.explode(sides).alias("s")).select(
        "word", "n", "s.reverse", F.pmod(F.xxhash64("s.reverse", "s.edge"), F.lit(buckets)).alias("bucket")
    )
    key = F.struct("reverse", "bucket")
    parts = settle(dealt.groupBy(key.alias("key")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")))
    cut = join_small(dealt.withColumn("key", key), parts, "key").withColumn("part", F.pmod(F.hash("word"), F.col("parts")))
    # A word is listed in its own part of the index, and asked of every part, in its own part of the queries.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: F.array(F.struct(F.col("part").alias("i"), k.alias("q")), F.struct(k.alias("i"), F.col("part").alias("q"))),
    )
    places = F.array_distinct(F.flatten(meets))
    spread = cut.select("key", "part", "word", "n", F.col("key.reverse").alias("reverse"), F.explode(places).alias("at"))
    asked = spread.select(
        "key", "at.i", "at.q", "word", "n", "reverse",
        (F.col("at.i") == F.col("part")).alias("listed"), (F.col("at.q") == F.col("part")).alias("asks"),
    )
    met = asked.groupBy("key", "i", "q").applyInArrow(_meet, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    merged = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the end of each word's chain of forms.

    Each round doubles the steps taken. Counts grow FACTOR times with every form, so chains have a
    few tens of words at most; a form is near to its words, so no key is hot.
    """
    held = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        now = held.select("word", "root")
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = now.join(further, "root", "left")
        after = settle(joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        release(held)
        held = after
        if not held.filter("moved").limit(1).count():
            return held.select("word", "root")


def variants(counted: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``counted`` (word, n), which must be settled."""
    near = near_words(counted)
    joined = settle(counted.join(near, "word", "left"))
    enough = F.col("near_n") >= FACTOR * F.col("n")
    formed = joined.select(
        "word", F.when(enough, F.col("near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("near_n")).alias("form_n"),
    )
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
