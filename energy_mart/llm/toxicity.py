"""Toxicity scores from positive and unlabelled texts (non-negative PU learning).

Confirmed toxic training texts are the positives; other training texts, taken as they come, are
unlabelled: toxic ones may hide among them. A linear model over hashed words is trained on
prior * R(positives as 1) + max(0, R(unlabelled as 0) - prior * R(positives as 0)), R being the mean
logistic loss; where the second part falls below zero, a step undoes it instead (the non-negative
correction). Only words that stand clearly more often in positives than in unlabelled texts (a
z-score of LEAST_Z) have a weight. The prior is the toxic share of the labelled training rows.
FOLDS models, each without another part of the sample, are trained in parallel and averaged.

The sample is bounded: about MOST_POSITIVE and MOST_UNLABELLED texts, picked by a hash of doc_id. Every
text is scored whole, by its distinct words. Held-out rows (crc32 of doc_id as text mod 5 is 0)
give neither labels nor texts to training; labels, lang, source and doc_id are no features.

Null or empty text scores by the bias alone. A null doc_id has no label and is never held out. If
several label rows share an id, one toxic mark is enough. Without positives all scores are 0.
Repeated rows are each scored. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.llm.common import arrow_pass, ascii_lower, batch_of, importable, settle

BITS, FOLDS, MOST_POSITIVE, MOST_UNLABELLED = 17, 4, 6000, 16000
EPOCHS, RATE, RIDGE, LEAST_Z = 400, 0.05, 1e-4, 4.0
KNOWN_WORDS = 300_000
_STRIP = b" .,;:!?\"'()[]{}<>*#$%&|-_/\\"


class Words(dict):
    """Word to place of its feature; forgets everything when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.strip(_STRIP)) & ((1 << BITS) - 1)
        return value


def features(text: str | None, known: Words) -> np.ndarray:
    """Places of the distinct words of a text."""
    words = set(ascii_lower((text or "").encode()).split())
    places = set(map(known.__getitem__, words))
    return np.fromiter(places, np.int32, len(places))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(rows: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias; Adam on the non-negative PU risk over all rows at once."""
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    places = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    n_pos, n_un = max(int(positive.sum()), 1), max(int(unlabelled.sum()), 1)
    in_pos = np.bincount(places, positive[doc], 1 << BITS) / n_pos
    in_un = np.bincount(places, unlabelled[doc], 1 << BITS) / n_un
    both = (in_pos * n_pos + in_un * n_un + 1) / (n_pos + n_un + 2)
    z = (in_pos - in_un) / np.sqrt(both * (1 - both) * (1 / n_pos + 1 / n_un))
    telling = z[places] >= LEAST_Z
    doc = doc[telling]
    used, cols = np.unique(places[telling], return_inverse=True)
    w, bias = np.zeros(len(used) + 1), np.log(prior / (1 - prior))
    w[-1] = bias
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, EPOCHS + 1):
        logit = np.bincount(doc, w[cols], len(rows)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        as_zero = np.logaddexp(0, logit)
        negative = (as_zero * unlabelled).sum() / n_un - prior * (as_zero * positive).sum() / n_pos
        up = prior * positive * (p - 1) / n_pos
        down = unlabelled * p / n_un - prior * positive * p / n_pos
        pull = up + down if negative >= 0 else -down
        grad = np.append(np.bincount(cols, pull[doc], len(used)), pull.sum())
        grad[:-1] += RIDGE * w[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w[:-1]
    return weights, float(w[-1])


def _sampled(key: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1_000_000)) < int(round(min(1.0, share) * 1_000_000))


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """Mean weights and bias of the folds; None without positives."""
    importable(docs.sparkSession)
    marked = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    marked = settle(marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    n, toxic = marked.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic:
        return None
    prior = min(max(toxic / n, 1e-4), 0.9)
    positives = marked.filter(F.col("toxic") == 1).filter(_sampled(F.col("doc_id"), MOST_POSITIVE / toxic)).select("doc_id", F.lit(True).alias("positive"))
    share = MOST_UNLABELLED / max(docs.count(), 1)
    own = docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Bounded by MOST_POSITIVE rows.
    picked = own.join(F.broadcast(positives), "doc_id", "left").withColumn("unlabelled", F.coalesce(_sampled(F.col("doc_id"), share), F.lit(False)))
    picked = picked.filter("positive OR unlabelled").select("doc_id", "text", F.coalesce("positive", F.lit(False)).alias("positive"), "unlabelled")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            found = [np.sort(features(t.as_py(), known)).tobytes() for t in batch.column(1)]
            yield batch_of({
                "doc_id": (batch.column(0).to_pylist(), pa.int64()), "positive": (batch.column(2).to_pylist(), pa.bool_()),
                "unlabelled": (batch.column(3).to_pylist(), pa.bool_()), "places": (found, pa.binary()),
            })

    rows = arrow_pass(picked, places, "doc_id long, positive boolean, unlabelled boolean, places binary")
    own_fold = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(FOLDS)).cast("int")
    others = F.filter(F.array(*[F.lit(k) for k in range(FOLDS)]), lambda k: k != own_fold)
    folds = rows.withColumn("fold", F.explode(others))

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "places"])  # the same sums in every run
        found = [np.frombuffer(x, np.int32) for x in part["places"]]
        weights, bias = fit(found, part["positive"].to_numpy(float), part["unlabelled"].to_numpy(float), prior)
        return pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias], "positives": [int(part["positive"].sum())]})

    models = folds.groupBy("fold").applyInPandas(learn, "weights binary, bias double, positives long").collect()  # FOLDS rows
    able = [m for m in models if m["positives"]]
    weights = np.mean([np.frombuffer(m["weights"], np.float32) for m in able], axis=0)
    return weights, float(np.mean([m["bias"] for m in able]))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, learnt = Words(), shared.value
        for batch in batches:
            if learnt is None:
                scores = np.zeros(batch.num_rows)
            else:
                weights, bias = learnt
                logits = np.array([weights[np.sort(features(t.as_py(), known))].sum(dtype=np.float64) + bias for t in batch.column(1)])
                scores = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            yield batch_of({
                "doc_id": (batch.column(0).to_pylist(), pa.int64()), "held_out": (batch.column(2).to_pylist(), pa.bool_()),
                "score": (scores, pa.float64()), "predicted": ((scores >= 0.5).astype(np.int32), pa.int32()),
            })

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return arrow_pass(own, rate, "doc_id long, held_out boolean, score double, predicted int")
