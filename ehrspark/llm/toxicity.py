"""Toxicity by multiple-instance learning (operator 10).

A document is a bag of sentences. A sentence scores sigmoid(w.x + b) on its
hashed words and word beginnings, the document by noisy-or of its sentences:
1 - prod(1 - p). A sentence without a telling feature counts 0 there, and any
other by what it scores above a floor, so that length alone adds nothing. Only documents are labelled; gradients of their likelihood
reach the sentences through the noisy-or, so the sentences that explain the
labels are found on the way. Gradients are summed by Spark over all labelled
documents; weights and gradients are vectors of a fixed number of buckets.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import DROPS, claim, slices, summed

BUCKETS = 1 << 18
STEM = 5  # letters of a word that count as its beginning
FLOOR = 0.02  # a sentence up to here is an ordinary one
PARTS = re.compile(r"[^\W\d_]+|[.!?\n]")
SENTENCE = re.compile(r"[^.!?\n]*[^\W\d_][^.!?\n]*[.!?]*")
KNOWN: dict[str, tuple[int, int]] = {}
DROPS["toxicity"] = KNOWN.clear


def buckets(word: str) -> tuple[int, int]:
    """Buckets of a lower-case word and of its beginning."""
    if len(KNOWN) > 400_000:
        KNOWN.clear()
    found = KNOWN[word] = zlib.crc32(word.encode()) % BUCKETS, zlib.crc32(b"^" + word[:STEM].encode()) % BUCKETS
    return found


def sentences(text: str) -> tuple[list[int], list[int]]:
    """Features of all sentences that have a letter, and where each begins.

    A sentence ends at a full stop, exclamation or question mark or a line's
    end. A word counts each time it stands there.
    """
    ids: list[int] = []
    starts: list[int] = []
    fresh, known = True, KNOWN.get
    for part in PARTS.findall(text.lower()):
        if part in ".!?\n":
            fresh = True
            continue
        if fresh:
            starts.append(len(ids))
            fresh = False
        ids += known(part) or buckets(part)
    return ids, starts


def forward(w: np.ndarray, bias: float, ids: np.ndarray, starts: np.ndarray, docs: np.ndarray, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Sentence scores above ``floor``, and for each document log(prod(1 - p)); ``docs``: where each one's sentences begin, and the end."""
    z = np.add.reduceat(w[ids], starts) + bias if len(starts) else np.zeros(0)
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    p = (p - floor) / (1 - floor)  # below 0 for an ordinary sentence
    some = np.flatnonzero(np.diff(docs))
    clean = np.zeros(len(docs) - 1)
    clean[some] = np.add.reduceat(np.log1p(-np.maximum(p, 0)), docs[some]) if len(some) else 0
    return p, clean


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    learnt: bool = True  # from both labels

    @property
    def floor(self) -> float:
        """At least what a sentence without a telling feature scores."""
        return max(FLOOR, float(1 / (1 + np.exp(-self.bias))))


def encode(docs: DataFrame) -> DataFrame:
    """(toxic, ids, starts) of labelled texts, one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        for batch in slices(batches, "text", 1 << 20):
            rows = [sentences(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([np.array(i, "<u4").tobytes() for i, _ in rows], pa.binary()),
                                              pa.array([np.array(s, "<u4").tobytes() for _, s in rows], pa.binary())], ["toxic", "ids", "starts"])

    return docs.select(F.col("toxic").cast("int").alias("toxic"), F.col("text").cast("string").alias("text")).mapInArrow(run, "toxic int, ids binary, starts binary")


def bags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels, features, sentence starts and document starts of encoded rows."""
    ids = [np.frombuffer(b, "<u4") for b in batch.column("ids").to_pylist()]
    starts = [np.frombuffer(b, "<u4").astype(np.int64) for b in batch.column("starts").to_pylist()]
    base = np.cumsum([0, *map(len, ids)])
    return (np.array(batch.column("toxic").to_pylist(), float), np.concatenate(ids).astype(np.int64), np.concatenate([s + b for s, b in zip(starts, base)]),
            np.cumsum([0, *map(len, starts)]))


def fit(docs: DataFrame, train: Column, steps: int = 40, rate: float = 0.5, penalty: float = 0.02, trust: float = 10.0, calm: float = 10.0, bias: float = -8.0, length: float = 10.0) -> Model:
    """Learn from all rows where ``train`` holds and ``toxic`` is 0 or 1 (others are left out).

    Weights start from the log-odds of documents with the feature, drawn
    towards 0 by ``trust`` documents. Features that speak for label 1 by more
    than a unit, in enough of its documents, then go ``steps`` full gradient
    steps, scaled for each by its past gradients (Adagrad from ``calm``); all
    others stay at 0, so that no document is learnt by its rare words. Only
    sentences with such a feature take part, and a document of label 0 counts
    as ``length`` of its kind in a row, as a clean text can be much longer than
    those with a label. Without both labels (``learnt`` is false) every text
    scores the one there is, or 0.5 without any.
    """
    rows = materialize(encode(docs.where(train & F.col("toxic").isin(0, 1))), "bags")

    def seen(batch: pa.RecordBatch) -> np.ndarray:
        """For each label: its documents with the feature; then the documents."""
        y, ids, starts, at = bags(batch)
        where = np.concatenate([starts, [len(ids)]])[at]
        pair = np.unique(np.repeat(np.arange(len(y)), np.diff(where)) * BUCKETS + ids)
        out = np.zeros(2 * BUCKETS + 2)
        for label in (0, 1):
            out[label * BUCKETS : (label + 1) * BUCKETS] = np.bincount(pair[y[pair // BUCKETS] == label] % BUCKETS, minlength=BUCKETS)
            out[2 * BUCKETS + label] = (y == label).sum()
        return out

    counts = summed(rows, "ids", seen, 2 * BUCKETS + 2)
    n = counts[2 * BUCKETS :]
    if not n.all():
        return Model(np.zeros(BUCKETS), 0.0 if not n.any() else (-30.0, 30.0)[int(n[1] > 0)], False)
    a, b = counts[BUCKETS : 2 * BUCKETS], counts[:BUCKETS]
    w = np.where(a + b > 0, np.log((a + 1) / (n[1] + 2)) - np.log((b + 1) / (n[0] + 2)), 0.0)
    w *= (a + b) / (a + b + trust)  # words of few documents tell little
    telling = (w > 1) & (a >= np.clip(n[1] / 50, 2, 20))
    w = np.where(telling, w, 0.0)
    spoken = docs.sparkSession.sparkContext.broadcast(telling)

    def telling_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bags of the sentences with a telling feature, and of those features alone."""
        for batch in batches:
            out = []
            for y, ids, starts in zip(*(batch.column(c).to_pylist() for c in ("toxic", "ids", "starts"))):
                ids, starts = np.frombuffer(ids, "<u4"), np.frombuffer(starts, "<u4")
                at = np.flatnonzero(spoken.value[ids])
                if len(at):
                    first = np.flatnonzero(np.diff(np.searchsorted(starts, at, "right"), prepend=0))
                    out.append((y, ids[at].tobytes(), first.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ((), (), ()), (pa.int32(), pa.binary(), pa.binary()))], ["toxic", "ids", "starts"])

    few = materialize(rows.mapInArrow(telling_only, "toxic int, ids binary, starts binary"), "telling")
    past = np.full(BUCKETS + 1, calm)
    for _ in range(steps):
        shared = docs.sparkSession.sparkContext.broadcast((w, bias))

        def slope(batch: pa.RecordBatch) -> np.ndarray:
            y, ids, starts, at = bags(batch)
            w_, b_ = shared.value
            p, clean = forward(w_, b_, ids, starts, at)
            toxic = -np.expm1(clean)
            # The likelihood's slope by a sentence's z is p (1 - P) / P for label 1, -p for label 0.
            factor = np.where(y > 0, np.exp(clean) / np.maximum(toxic, 1e-9), -length)
            g = p * np.repeat(factor, np.diff(at))
            n_words = np.diff(np.append(starts, len(ids)))
            return np.append(np.bincount(ids, np.repeat(g, n_words), BUCKETS), g.sum())

        g = summed(few, "ids", slope, BUCKETS + 1)
        g[:-1] = np.where(telling, g[:-1] - penalty * w, 0.0)
        past += g * g
        move = rate * g / np.sqrt(past)
        w, bias = w + move[:-1], bias + move[-1]
        shared.destroy()
    return Model(w, float(bias))


def score(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """Every column of ``docs`` that is asked for, with score, predicted,
    n_sentences and worst (number of the highest-scoring sentence, null if
    there is none); with ``spans`` also offending: start, end (code points) and
    score of each sentence that alone scores 0.5 or more.

    Sentence scores are those above the model's floor. ``docs`` must have a
    string column ``text``; one without a sentence, or without a telling
    feature, scores 0. A model without both labels scores each text alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        m = shared.value
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            toxic, count, worst, found = [], [], [], []
            for t in texts:
                ids, starts = sentences(t)
                p, clean = forward(m.weights, m.bias, np.array(ids, np.int64), np.array(starts, np.int64), np.array([0, len(starts)]), m.floor if m.learnt else 0.0)
                toxic.append(float(-np.expm1(clean[0]) if m.learnt else 1 / (1 + np.exp(-m.bias))))
                count.append(len(p))
                worst.append(int(p.argmax()) if len(p) else None)
                if spans:
                    places = [x.span() for x in SENTENCE.finditer(t)] if m.learnt and p.size and p.max() >= 0.5 else []
                    found.append([{"start": s, "end": e, "score": float(v)} for (s, e), v in zip(places, p) if v >= 0.5])
            more = [pa.array(toxic, pa.float64()), pa.array([int(x >= 0.5) for x in toxic], pa.int32()), pa.array(count, pa.int32()), pa.array(worst, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more, *([pa.array(found, kind)] if spans else [])],
                                             [*batch.schema.names, "score", "predicted", "n_sentences", "worst", *(["offending"] if spans else [])])

    out = f"{fields}, score double, predicted int, n_sentences int, worst int" + ", offending array<struct<start: bigint, end: bigint, score: double>>" * spans
    return docs.mapInArrow(run, out)
