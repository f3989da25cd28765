"""Language by multinomial naive Bayes over hashed character n-grams (operator 7).

Training counts n-grams of each language over all training documents, one
vector of ``buckets`` counts for each language and task, summed by Spark. The
matrix of log-probabilities is broadcast: its size is languages x buckets, so
the number of languages is held to ``max_languages`` (beyond it: an error).
Texts are scored in numpy, by adding the matrix rows of their n-grams.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import claim, slices

ORDERS = 4  # n-grams of 1 to 4 letters
BUCKETS = 1 << 16
SEGMENT = 1 << 19
CHUNK = 1 << 13  # buckets in a row of counts
#: Multipliers of the rolling hash, one for each place in an n-gram.
PLACES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@cache
def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            out[c] = ord(unicodedata.normalize("NFC", ch.lower())[0])
    return out


def parts(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The texts in groups of about SEGMENT characters, with their numbers; a
    longer text is cut into segments, which n-grams don't cross."""
    numbers, group, size = [], [], 0
    for i, t in enumerate(texts):
        for k in range(0, max(1, len(t)), SEGMENT):
            piece = t[k : k + SEGMENT]
            if group and size + len(piece) > SEGMENT:
                yield np.array(numbers), group
                numbers, group, size = [], [], 0
            numbers.append(i)
            group.append(piece)
            size += len(piece)
    if group:
        yield np.array(numbers), group


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of all n-grams and where each text's begin
    (and the last one's end). A text counts as its letters and single spaces,
    with a space on both ends; one without a letter has no n-gram."""
    raw = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    space = np.array([32], np.uint32)
    points = letters()[np.concatenate([x for r in raw for x in (space, r, space)])]
    owner = np.repeat(np.arange(len(raw), dtype=np.int32), [len(r) + 2 for r in raw])
    gap = points == 32
    keep = np.ones(len(points), bool)
    keep[1:] = ~(gap[1:] & gap[:-1] & (owner[1:] == owner[:-1]))
    points, owner, gap = points[keep], owner[keep], gap[keep]
    h = np.zeros(len(points), np.uint32)
    for n in range(1, ORDERS + 1):
        h = h[: len(points) - n + 1] + points[n - 1 :] * PLACES[n - 1]
        own = owner[: len(h)]
        here = own == owner[n - 1 :] if n > 1 else ~gap
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
        yield (mixed[here] >> np.uint32(33 - BUCKETS.bit_length())).astype(np.int32), np.searchsorted(own[here], np.arange(len(texts) + 1))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # languages x buckets, log-probabilities
    prior: np.ndarray


def fit(docs: DataFrame, train: Column, smoothing: float = 0.5, max_languages: int = 512) -> Model:
    """Learn from all rows where ``train`` holds and neither lang nor text is null.

    Each language's documents weigh the same by n-gram counts; the prior is the
    share of documents, smoothed. No such row: a model without languages.
    """
    some = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("langid")
        total: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for batch in slices(batches, "text", 1 << 19):
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for lang in set(langs):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                if lang not in total:
                    if len(total) >= max_languages:
                        raise ValueError(f"more than {max_languages} languages")
                    total[lang] = np.zeros(BUCKETS, np.int64)
                for _, group in parts(own):
                    for ids, _ in grams(group):
                        total[lang] += np.bincount(ids, minlength=BUCKETS)
                n_docs[lang] = n_docs.get(lang, 0) + len(own)
        for lang, counts in total.items():
            for k in range(0, BUCKETS, CHUNK):
                yield pa.RecordBatch.from_pylist([{"lang": lang, "chunk": k, "docs": n_docs[lang] if k == 0 else 0, "counts": counts[k : k + CHUNK].tobytes()}], COUNTS)

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(CHUNK, np.int64), 0
        for batch in batches:
            for counts, docs_ in zip(batch.column("counts").to_pylist(), batch.column("docs").to_pylist()):
                total, n = total + np.frombuffer(counts, np.int64), n + docs_
        yield pa.RecordBatch.from_pylist([{"lang": key[0].as_py(), "chunk": key[1].as_py(), "docs": n, "counts": total.tobytes()}], COUNTS)

    names = "lang string, chunk int, docs long, counts binary"
    rows = some.mapInArrow(run, names).groupBy("lang", "chunk").applyInArrow(merge, names).collect()  # languages x buckets
    languages = sorted({r["lang"] for r in rows})
    counts, n_docs = np.zeros((len(languages), BUCKETS)), np.zeros(len(languages))
    for r in rows:
        at = languages.index(r["lang"])
        counts[at, r["chunk"] : r["chunk"] + CHUNK] = np.frombuffer(r["counts"], np.int64)
        n_docs[at] += r["docs"]
    weights = np.log((counts + smoothing) / (counts.sum(1, keepdims=True) + smoothing * BUCKETS))
    return Model(languages, weights, np.log((n_docs + 1) / (n_docs.sum() + max(1, len(languages)))))


COUNTS = pa.schema([("lang", pa.string()), ("chunk", pa.int32()), ("docs", pa.int64()), ("counts", pa.binary())])


def predict(docs: DataFrame, model: Model, counted: bool = False) -> DataFrame:
    """Every column of ``docs`` that is asked for, with lang_pred and score; with
    ``counted`` also n_grams, which is 0 for a text that is null or has no letter, and
    evidence: by how much the mean log-probability of an n-gram in that
    language is above chance, all buckets being equally likely (null if there is none).

    ``docs`` must have a string column ``text``. A text that is null or has no
    letter is ``und`` with score 0, as is every text if no language was learnt;
    ties go to the language first by code point. The score is the posterior
    probability, tempered: naive Bayes counts overlapping n-grams as if they
    told independent things, so the evidence is divided by their orders.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("langid")
        m = shared.value
        for batch in slices(batches, "text", 1 << 19):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            label, score, evidence = np.full(len(texts), "und", object), np.zeros(len(texts)), np.full(len(texts), None, object)
            logs, n_grams = np.zeros((len(texts), len(m.languages))), np.zeros(len(texts), np.int64)
            for numbers, group in parts(texts) if texts else ():
                for ids, at in grams(group):
                    some = np.flatnonzero(np.diff(at))
                    np.add.at(n_grams, numbers, np.diff(at))
                    for k in range(len(m.languages) if len(some) else 0):
                        np.add.at(logs[:, k], numbers[some], np.add.reduceat(m.weights[k][ids], at[some]))
            if m.languages and len(some := np.flatnonzero(n_grams)):
                evidence[some] = logs[some].max(1) / n_grams[some] + np.log(BUCKETS)
                logs = logs[some] / ORDERS + m.prior
                label[some] = np.array(m.languages, object)[logs.argmax(1)]
                score[some] = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(label, pa.string()), pa.array(score), *[pa.array(n_grams), pa.array(evidence, pa.float64())] * counted], [*batch.schema.names, "lang_pred", "score", *["n_grams", "evidence"] * counted])

    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double" + ", n_grams long, evidence double" * counted)
