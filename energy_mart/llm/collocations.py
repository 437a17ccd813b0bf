"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

``phrases(docs)`` counts, per language, every phrase of up to MOST_WORDS words that occurs LEAST
times or more; ``collocations(docs)`` scores and ranks those of two words and more.

Two passes over the texts per length. A task keeps, per prefix, a stripe: an associative
counter of next words. Stripes are merged elementwise by Spark, as rows (lang, prefix, next, f), so
the stripe of a very common prefix is spread over all tasks and combined before the shuffle. The
stripe of the empty prefix holds the words; the entry of a phrase in its own prefix's stripe is that
phrase's frequency, so a prefix's total stands in the stripe one word shorter. The stripes give
all that is asked: extensions (their entries), totals, and subsumption maxima (the largest
entry of a phrase's own stripe, and the largest entry that ends in the phrase).

A phrase cannot occur more often than its parts. So a pass counts only places where both parts
that lack one word were frequent in the pass before; these are looked up in a bitmap of fixed largest
size (BITS at most), whose false hits cost time only: every count is exact, and phrases below LEAST go
after the merge. Most of these places hold phrases that are rare after all, so their 64-bit hashes are
counted first, and stripes are made of phrases whose hash is frequent: a collision lets a rare phrase through, none is lost.
Arithmetic is on decimals of 38 digits.

Null language: ``und``. Null or empty text has no words. Repeated rows count each time. Extra
columns are not read. An empty table has no phrases. A text is worked on in slices that end
between pieces, so a very long one takes no more memory than others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from energy_mart.llm.common import arrow_pass, settle

MOST_WORDS, LEAST, TOP = 5, 100, 2000
UNKNOWN = "und"
#: Bytes of text per slice, and the largest bitmap (2 ** 27 bits: 16 MB).
SLICE, BITS = 8 << 20, 27
_PIECE, _BLANK = b"\n", b" "
#: A-Z to a-z, marks and line ends that close a piece to \n, tab to blank.
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + 9 * _PIECE + _BLANK
)
_MIX, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: The stripes of a slice, laid end to end.
STRIPES = "lang string, stripes array<struct<prefix:string,next:string,count:bigint>>"


@dataclass
class Known:
    """Bitmap of phrases: bit ``hash >> (64 - width)`` is set for each."""

    width: int
    bits: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - self.width)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _word_hashes(dictionary: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in dictionary.to_pylist()), np.uint64, len(dictionary))


def _phrase_hashes(lang: bytes, words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that begin at each place."""
    n = max(0, len(words) - size + 1)
    out = np.full(n, xxhash.xxh64_intdigest(lang), np.uint64)
    for j in range(size):
        out = out * _MIX + words[j : j + n]
    return (out ^ (out >> np.uint64(32))) * _SPREAD


def slices(text: bytes) -> Iterator[bytes]:
    """Lower-cased stretches of about SLICE bytes that end with a piece."""
    plain, start = text.translate(_PLAIN), 0
    while start < len(plain):
        end = plain.rfind(_PIECE, start, start + SLICE) + 1
        if end <= start:
            end = plain.find(_PIECE, start + SLICE) + 1 or len(plain)
        if len(plain) <= start + SLICE:
            end = len(plain)
        yield plain[start:end]
        start = end


def placed_words(plain: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of each word, the distinct words, and the piece each word is in."""
    data = np.frombuffer(plain, np.uint8)
    mark = data == _PIECE[0]
    inside = ~mark & (data != _BLANK[0])
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.searchsorted(np.flatnonzero(mark), starts)


def _places(hashes: np.ndarray, piece: np.ndarray, size: int, known: Known) -> np.ndarray:
    """Where ``size`` words stand in one piece, both parts of one word less being known."""
    part = known.has(hashes)
    return np.flatnonzero(part[:-1] & part[1:] & (piece[: 1 - size] == piece[size - 1 :]))


def _hash_counts(lang: bytes, plain: bytes, size: int, parts: Known) -> pa.RecordBatch:
    """Hashes of the phrases of known parts in one slice, and how often each stands there."""
    codes, dictionary, piece = placed_words(plain)
    words = _word_hashes(dictionary)[codes]
    places = _places(_phrase_hashes(lang, words, size - 1), piece, size, parts)
    found, count = np.unique(_phrase_hashes(lang, words, size)[places], return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count.astype(np.int64))], names=["h", "n"])


def _stripes(lang: bytes, plain: bytes, size: int, known: Known | None) -> pa.RecordBatch | None:
    """The stripes of the prefixes of ``size - 1`` words in one slice, in one row."""
    codes, dictionary, piece = placed_words(plain)
    k = len(dictionary)
    if size == 1:
        prefix, following, count = np.zeros(k, np.int64), np.arange(k), np.bincount(codes, minlength=k)
        names = pa.array([b""] * k, pa.binary())
    else:
        words = _word_hashes(dictionary)[codes]
        places = np.flatnonzero(known.has(_phrase_hashes(lang, words, size)) & (piece[: 1 - size] == piece[size - 1 :]))
        prefix = codes[places]
        for j in range(1, size - 1):
            prefix = np.unique(prefix * k + codes[places + j], return_inverse=True)[1]
        entry = prefix * k + codes[places + size - 1]
        if size == 2:
            found, count = np.unique(entry, return_counts=True)
            first = None
        else:
            found, first, count = np.unique(entry, return_index=True, return_counts=True)
        prefix, following = np.divmod(found, k) if k else (found, found)
        if size == 2:
            names = dictionary.take(pa.array(prefix))
        else:
            at = places[first]
            names = pc.binary_join_element_wise(*[dictionary.take(pa.array(codes[at + j])) for j in range(size - 1)], _BLANK)
    if not len(following):
        return None
    entries = pa.StructArray.from_arrays(
        [names.cast(pa.string()), dictionary.take(pa.array(following)).cast(pa.string()), pa.array(count.astype(np.int64))],
        ["prefix", "next", "count"],
    )
    stripes = pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries)
    return pa.RecordBatch.from_arrays([pa.array([lang.decode()], pa.string()), stripes], names=["lang", "stripes"])


def _per_slice(texts: DataFrame, work, schema: str) -> DataFrame:
    """``work(lang, slice)`` for every slice of ``texts`` (lang, text as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, bodies = batch.column(0).dictionary_encode(), batch.column(1)
            of = langs.indices.to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                # A piece ends with its text: texts of one language are joined by a line end.
                text = _PIECE.join(bodies.take(pa.array(np.flatnonzero(of == code))).to_pylist())
                for plain in slices(text):
                    out = work(lang.encode(), plain)
                    if out is not None:
                        yield out

    return arrow_pass(texts, run, schema)


def stripes(texts: DataFrame, size: int, known=None) -> DataFrame:
    """(lang, prefix, next, f): merged stripes of the prefixes of ``size - 1`` words.

    ``known`` is a broadcast ``Known`` of the phrases to count; words are all counted.
    """
    entries = _per_slice(texts, lambda lang, plain: _stripes(lang, plain, size, known.value if known else None), STRIPES)
    return entries.select("lang", F.inline("stripes")).groupBy("lang", "prefix", "next").agg(F.sum("count").alias("f"))


def frequent_hashes(texts: DataFrame, size: int, parts, least: int) -> DataFrame:
    """(h): hashes that phrases of known parts (a broadcast ``Known``) have ``least`` times or more together."""
    counted = _per_slice(texts, lambda lang, plain: _hash_counts(lang, plain, size, parts.value), "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("h")


def phrase_hashes(frequent: DataFrame, size: int) -> DataFrame:
    """(h): hashes of the phrases ``prefix next`` of ``size`` words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, prefix, word in zip(*(c.to_pylist() for c in batch.columns)):
                words = [*prefix.encode().split(_BLANK), word.encode()] if prefix else [word.encode()]
                hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
                out.append(_phrase_hashes(lang.encode(), hashes, size).view(np.int64)[0])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["h"])

    return arrow_pass(frequent.select("lang", "prefix", "next"), hashed, "h long")


def bitmap(hashes: DataFrame, room: int) -> Known:
    """Bitmap of settled ``hashes`` (h), with ``room`` bits or more for each while BITS allows."""
    width = int(min(BITS, max(15, np.ceil(np.log2(room * hashes.count() + 1)))))
    # The built-ins count places and buckets from 1. Rows of 4 KB, at most 2 ** (BITS - 15) of them.
    place = F.shiftrightunsigned("h", 64 - width) + 1
    found = hashes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    bits = np.zeros((1 << width) // 8, np.uint8)
    for row in found.collect():
        start = (row["bucket"] - 1) * 4096
        part = np.frombuffer(bytes(row["bits"]), np.uint8)[: len(bits) - start]
        bits[start : start + len(part)] = part
    return Known(width, bits)


def phrases(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Settled (lang, prefix, next, size, f) of frequent phrases, and (lang, n) of all words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    words = settle(stripes(texts, 1))
    totals = settle(words.groupBy("lang").agg(F.sum("f").alias("n")))
    level = words.filter(F.col("f") >= least)
    levels = [level.withColumn("size", F.lit(1))]
    for size in range(2, most_words + 1):
        shorter = bitmap(settle(phrase_hashes(level, size - 1)), 16)
        if not shorter.bits.any():
            break
        parts = spark.sparkContext.broadcast(shorter)
        known = spark.sparkContext.broadcast(bitmap(settle(frequent_hashes(texts, size, parts, least)), 1024))
        level = settle(stripes(texts, size, known).filter(F.col("f") >= least))
        for used in (parts, known):
            used.unpersist()
        levels.append(level.withColumn("size", F.lit(size)))
    out = levels[0]
    for part in levels[1:]:
        out = out.unionByName(part)
    return out, totals


def collocations(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language.

    a, l, r are the frequencies of the phrase and of both sides of its worst cut (the smallest
    on ties), n the language's words, score 1000 * a * n / (l * r), floored. Phrases that
    stand in one with a word more as often as alone are left out. Order: score, a (both falling), phrase.
    """
    stored, totals = phrases(docs, least, most_words)
    name = F.when(F.col("size") == 1, F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    known = settle(stored.withColumn("phrase", name).withColumn("words", F.split("phrase", " ")))
    longer = known.filter("size > 1")
    after = longer.select("lang", F.col("prefix").alias("phrase"), "f")
    before = longer.select("lang", F.array_join(F.slice("words", 2, F.col("size") - 1), " ").alias("phrase"), "f")
    widest = after.unionByName(before).groupBy("lang", "phrase").agg(F.max("f").alias("within"))
    alone = (
        longer.join(widest, ["lang", "phrase"], "left")
        .filter("within IS NULL OR within < f")
        .select("lang", "phrase", "words", "size", F.col("f").alias("a"))
    )
    cuts = alone.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    part = lambda side, f: known.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    scored = (
        cuts.join(part("first", "l"), ["lang", "first"])
        .join(part("rest", "r"), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", F.expr(
            "(CAST(1000 * a AS DECIMAL(20,0)) * CAST(n AS DECIMAL(18,0))) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
        ))
    )
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("w"))
    ranked = worst.select("lang", "phrase", "w.a", "w.l", "w.r", "w.n", "w.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    placed = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return placed.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
