"""Packing documents into fixed windows by non-negative least squares over length patterns.

A document is its token ids and one end id. Whole windows are cut off its front; what remains is a
rest of 1 to WINDOW - 1 tokens. The rests' lengths form a histogram of at most WINDOW - 1 numbers, which is
all that reaches the driver. Patterns that fill a window are enumerated: two or three lengths (three only among the
commonest), or a common length many times with one or two others. Their repeat counts are solved against the
histogram by non-negative least squares, rounded down, and kept within what is there. Rests are numbered within their
length over sorted partitions (one shuffle), so each finds its pattern and repeat by its number. Rests that no
pattern takes are packed greedily, end to end on a tape; one that meets the end of a window's part of the tape is cut
at its last stretch of CUT tokens before it, and a window has room for what the one before it so leaves over.
Checksums of cut pieces are joined from those of their stretches.

Null or empty text: the end id alone. Repeated rows are packed as often as they stand. Other columns
are ignored. A text of any length is encoded word by word.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from energy_mart.llm.common import arrow_pass, settle
from energy_mart.session import release

WINDOW, END_ID = 2048, 1
#: Tokens between the places where a rest may be cut; each stretch has its checksum.
CUT = 16
#: Lengths that may stand in patterns of three, most common first; steps of the solver.
COMMON, STEPS, TRIES = 64, 400, 4
KNOWN_WORDS = 300_000
#: Texts encoded together.
BATCH = 1500
_GAPS, _SIGNS = re.compile(r"[ \n\t]+"), re.compile("[\x1c-\x1f]")
#: Lower-case Latin-1 as the tokenizer cuts it where no apostrophe stands: letters, a number, other signs.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
_RUNS = re.compile(f"[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _kind(byte: int) -> bytes:
    """Of a Latin-1 character: a stop, another sign, a separator the tokenizer takes for a sign, or none."""
    c = chr(byte)
    if c in ".,":
        return b"p"
    if "\x1c" <= c <= "\x1f":
        return b"c"
    return b" " if c.isalnum() or c.isspace() else b"s"


_KINDS = b"".join(map(_kind, range(256)))


def chunks(text: str) -> list[str]:
    """Stretches of a text whose ids, one after another, are the text's ids.

    The tokenizer lower-cases, and neither white space nor the seam between a letter or number
    and a lone full stop or comma is ever inside one of its words. Latin-1 text has one lower case
    and one normal form, so it is lower-cased and cut there, which leaves fewer distinct stretches; where signs
    stand together, it is cut at every seam of letters, numbers and signs, unless an apostrophe may start a word.
    """
    try:
        kinds = text.encode("latin-1").translate(_KINDS)
    except UnicodeEncodeError:
        return _GAPS.split(text) if _SIGNS.search(text) else text.split()
    if b"c" in kinds:  # Python splits at these, the tokenizer does not
        return _GAPS.split(text)
    if "<|" in text:
        return text.split()
    if b"pp" in kinds or b"ps" in kinds or b"sp" in kinds:
        return text.lower().split() if "'" in text else _RUNS.findall(text.lower())
    return text.lower().replace(",", " , ").replace(".", " . ").split()


class Encoder:
    """Ids of texts as bytes, little-endian unsigned 32 bits, with the end id.

    A process remembers KNOWN_WORDS stretches that it met in two batches of texts; others are encoded
    for their batch.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.known: dict[str, bytes] = {}
        self.met: set[int] = set()
        self.end = np.array([END_ID], "<u4").tobytes()

    def texts(self, texts: list[str | None]) -> list[bytes]:
        rows, known, met = [chunks(t or "") for t in texts], self.known, self.met
        distinct: set[str] = set()
        for words in rows:
            distinct.update(words)
        missing = list(distinct.difference(known))
        known.update(self._words(missing))
        out = [b"".join(map(known.__getitem__, words)) + self.end for words in rows]
        room = KNOWN_WORDS - len(known) + len(missing)
        if len(met) > 4 * KNOWN_WORDS:
            met.clear()
        for word in missing:
            mark = hash(word)
            if mark in met and room > 0:
                room -= 1
            else:
                met.add(mark)
                del known[word]
        return out

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new stretches; Latin-1 words of letters are encoded many at a time."""
        letters = [w for w in words if w.isalpha() and max(w) <= "\xff"]
        other = list(set(words).difference(letters))
        coded = self.tokenizer.encode_batch(other, add_special_tokens=False)
        out = {w: np.array(c.ids, "<u4").tobytes() for w, c in zip(other, coded)}
        for at in range(0, len(letters), 5000):
            part = letters[at : at + 5000]
            one = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(one.ids, "<u4").tobytes()
            starts = (4 * np.flatnonzero(np.diff(np.array(one.word_ids), prepend=-1))).tolist()
            if len(starts) != len(part):
                raise ValueError("a word of letters is not one pre-token")
            out.update((w, ids[a:b]) for w, a, b in zip(part, starts, [*starts[1:], len(ids)]))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The process's own."""
    return Encoder(path)


def encode(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, doc_tokens, whole: checksums of whole windows, rest: length, stretches: its checksums)."""
    schema = "doc_id long, doc_tokens long, whole array<long>, rest int, rest_crc32 long, stretches array<long>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, wide = encoder(tokenizer).texts, 4 * window
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part, out = batch.slice(at, BATCH), []
                for ids in encode_texts(part.column(1).to_pylist()):
                    n = len(ids) // wide
                    rest = ids[n * wide :]
                    out.append((
                        len(ids) // 4, [zlib.crc32(ids[i * wide : (i + 1) * wide]) for i in range(n)], len(rest) // 4, zlib.crc32(rest),
                        [zlib.crc32(rest[i : i + 4 * CUT]) for i in range(0, len(rest), 4 * CUT)],
                    ))
                total, whole, rests, crcs, stretches = zip(*out) if out else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total, pa.int64()), pa.array(whole, pa.list_(pa.int64())), pa.array(rests, pa.int32()),
                     pa.array(crcs, pa.int64()), pa.array(stretches, pa.list_(pa.int64()))],
                    names=["doc_id", "doc_tokens", "whole", "rest", "rest_crc32", "stretches"],
                )

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), rows, schema)


def patterns(histogram: np.ndarray) -> list[tuple[int, ...]]:
    """Shallow combinations of occurring lengths that fill a window exactly or nearly."""
    window = len(histogram)
    there = np.flatnonzero(histogram)
    found: dict[tuple[int, ...], None] = {}
    for low in there:  # the partner that leaves least room
        fits = there[: np.searchsorted(there, window - low, "right")]
        if len(fits) and window - low - fits[-1] < CUT:
            found[tuple(sorted((int(low), int(fits[-1]))))] = None
    common = np.sort(there[np.argsort(-histogram[there], kind="stable")][:COMMON])
    for i, a in enumerate(common):
        for b in common[i:]:
            fits = there[: np.searchsorted(there, window - a - b, "right")]
            if len(fits) and window - a - b - fits[-1] < CUT:
                found[tuple(sorted((int(a), int(b), int(fits[-1]))))] = None
    for a in common.tolist():  # short rests: one length again and again, then what fits beside
        for times in range(window // a, max(2, window // a - TRIES), -1):
            pattern, left = [a] * times, window - a * times
            for _ in range(2):
                fits = there[: np.searchsorted(there, left, "right")]
                if left >= CUT and len(fits):
                    pattern.append(int(fits[-1]))
                    left -= pattern[-1]
            if left < CUT:
                found[tuple(sorted(pattern))] = None
    return list(found)


def repeats(histogram: np.ndarray, chosen: list[tuple[int, ...]]) -> np.ndarray:
    """Whole repeat counts of the patterns, from least squares with no count below zero.

    Projected gradient with momentum; afterwards counts are rounded down and lowered until no length
    is used more often than it occurs.
    """
    counts = np.zeros(len(chosen))
    if not chosen:
        return counts.astype(np.int64)
    rows = np.concatenate([list(p) for p in chosen])
    cols = np.repeat(np.arange(len(chosen)), [len(p) for p in chosen])
    weight = np.sqrt(1.0 / np.maximum(histogram, 1))  # relative misses weigh alike
    apply = lambda x: np.bincount(rows, x[cols], len(histogram)) * weight
    back = lambda r: np.bincount(cols, (r * weight)[rows], len(chosen))
    probe = np.ones(len(chosen))
    for _ in range(20):
        probe = back(apply(probe))
        size = np.linalg.norm(probe)
        probe /= size
    target, moved, pace = histogram * weight, counts.copy(), 1.0
    for _ in range(STEPS):
        after = np.maximum(moved - back(apply(moved) - target) / size, 0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        moved, counts, pace = after + (pace - 1) / faster * (after - counts), after, faster
    whole = np.floor(counts + 1e-6).astype(np.int64)
    left = histogram.astype(np.int64).copy()
    for at in np.argsort(-whole, kind="stable"):
        lengths, times = np.unique(chosen[at], return_counts=True)
        whole[at] = max(0, min(int(whole[at]), *(int(left[n] // t) for n, t in zip(lengths, times))))
        left[lengths] -= whole[at] * times
    return whole


def _slots(chosen: list[tuple[int, ...]], counts: np.ndarray, window: int) -> tuple:
    """Which numbers of a length go to which pattern slot, sorted by (length, first number).

    Arrays: length, first number, end, and (first sequence * window + offset); then all sequences.
    """
    used: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in zip(chosen, counts.tolist()):
        if times:
            offset = 0
            for length in pattern:
                first = used.get(length, 0)
                out.append((length, first, first + times, sequence * window + offset))
                used[length] = first + times
                offset += length
            sequence += times
    return (*np.array(sorted(out), np.int64).reshape(-1, 4).T, sequence)


@lru_cache(maxsize=1)
def _shift_tables() -> list[list[int]]:
    """Tables that carry a checksum over four zero bytes, by its bytes."""
    zeros = lambda crc: zlib.crc32(bytes(4), crc ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return [[zeros(b << (8 * k)) for b in range(256)] for k in range(4)]


def join_checksums(parts: list[int], words: list[int]) -> int:
    """CRC-32 of stretches laid end to end, from theirs and their numbers of 32-bit words."""
    t0, t1, t2, t3 = _shift_tables()
    total = 0
    for crc, n in zip(parts, words):
        for _ in range(n):
            total = t0[total & 255] ^ t1[total >> 8 & 255] ^ t2[total >> 16 & 255] ^ t3[total >> 24]
        total ^= crc
    return total


def _placed(coded: DataFrame) -> DataFrame:
    """``coded`` settled in order of (rest, doc_id); part, place in it, whole windows before it there."""
    order = ["rest", "doc_id"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in coded.schema) + ", part int, row long, wholes_before long"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, wholes, part = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            sizes = np.array(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False), np.int64)
            ahead = wholes + np.cumsum(sizes) - sizes
            added = [pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(row, row + n), pa.int64()), pa.array(ahead, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "part", "row", "wholes_before"])
            row, wholes = row + n, wholes + int(sizes.sum())

    return settle(arrow_pass(coded.repartitionByRange(*order).sortWithinPartitions(*order), rows, schema))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (all long)."""
    coded = settle(encode(docs, tokenizer, window))  # sorting by range reads its input twice
    placed = _placed(coded)
    release(coded)
    counts = {r["rest"]: r["count"] for r in placed.filter("rest > 0").groupBy("rest").count().collect()}  # below WINDOW rows
    histogram = np.zeros(window, np.int64)
    histogram[list(counts)] = list(counts.values())
    chosen = patterns(histogram)
    lengths, firsts, ends, sequences, n_sequences = _slots(chosen, repeats(histogram, chosen), window)
    taken = np.zeros(window, np.int64)
    np.maximum.at(taken, lengths, ends)

    # Where numbering begins, per partition and length in it: about WINDOW rows and one per partition.
    sums = placed.groupBy("part", "rest").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"), F.sum(F.size("whole")).alias("wholes")
    )
    before = Window.orderBy("rest", "part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rangeBetween(Window.unboundedPreceding, -1)
    took = F.get(F.lit(taken.tolist()).cast("array<bigint>"), F.col("rest"))
    left = F.greatest(F.col("number") + F.col("n") - took, F.lit(0)) - F.greatest(F.col("number") - took, F.lit(0))
    none = F.lit(0).cast("long")
    starts = settle(
        sums.withColumn("number", F.coalesce(F.sum("n").over(within), none))
        .withColumn("ahead", left * F.col("rest"))
        .withColumn("ahead", F.coalesce(F.sum("ahead").over(before), none))
        .withColumn("wholes", F.coalesce(F.sum("wholes").over(earlier), none))
        .select("part", "rest", "number", "first_row", "ahead", "wholes")
    )
    tail = n_sequences + (placed.agg(F.sum(F.size("whole"))).first()[0] or 0)
    inputs = ["doc_id", "doc_tokens", "whole", "rest", "rest_crc32", "stretches", "row", "wholes_before", "number", "first_row", "ahead", "wholes"]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    key = lengths * (1 << 40) + firsts
    # Of a window, the tape gives all but the most that a cut rest can bring along beyond it.
    tape = window - CUT + 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, total, whole, rest, crc, stretches, row, own, number, first, ahead, wholes in zip(*(c.to_pylist() for c in batch.columns)):
                at = n_sequences + wholes + own
                out += [(doc, i * window, window, c, total, at + i, 0) for i, c in enumerate(whole)]
                if not rest:
                    continue
                number += row - first
                start = total - rest
                if number < taken[rest]:
                    slot = int(np.searchsorted(key, rest * (1 << 40) + number, "right")) - 1
                    sequence, offset = divmod(int(sequences[slot]), window)
                    out.append((doc, start, rest, crc, total, sequence + number - int(firsts[slot]), offset))
                    continue
                begin = ahead + (number - max(int(taken[rest]), number - (row - first))) * rest
                cut = (-begin) % tape  # tokens of the rest before the next window's part begins
                if not 0 < cut < rest:
                    out.append((doc, start, rest, crc, total, tail + begin // tape, begin % tape))
                    continue
                sizes = [min(CUT, rest - i) for i in range(0, rest, CUT)]
                k = cut // CUT
                for lo, hi, where in ((0, k, begin), (k, len(sizes), begin + cut)):
                    if lo < hi:
                        joined = join_checksums(stretches[lo:hi], sizes[lo:hi])
                        out.append((doc, start + lo * CUT, sum(sizes[lo:hi]), joined, total, tail + where // tape, where % tape))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in schema.split(", ")])

    pieces = arrow_pass(placed.join(F.broadcast(starts), ["part", "rest"]).select(inputs), rows, schema)
    # Places on the tape so far; a window's pieces then close up.
    so_far = Window.partitionBy("sequence_id").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("offset", F.coalesce(F.sum("length").over(so_far), F.lit(0)).cast("long"))
