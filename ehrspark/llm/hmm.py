"""Hidden Markov language model (operator 1).

The model reads a text as words and one end. The most frequent words of the
training texts are classes of their own; all others share classes by their
last letters. Latent states emit classes, and a class its words by smoothed
counts of the whole training text, so a text has the probability

    P(classes, by the Markov chain) x product of P(word | class).

Word counts come from one pass over all training documents and stay a table,
as the vocabulary grows with them: the ``LEXICON`` most frequent words are
broadcast, other words meet their counts in a join. Baum-Welch runs over all
training documents; each round sums the expected counts of all partitions. The
scaled forward recursion gives the exact likelihood of every text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import documents, slices, summed

STATES, ROUNDS = 8, 8
LEXICON = 1 << 17  # words that are broadcast, at most
OWN, SHARED = 6143, 2048  # classes of one word, and by last letters; class 0 is the end
CLASSES = 1 + OWN + SHARED
SEGMENT = 1024  # tokens that Baum-Welch takes at a time
END = b""


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()  # of bytes: ASCII letters and white space only


def shared_class(word: bytes) -> int:
    return 1 + OWN + zlib.crc32(word[-3:]) % SHARED


def count_words(docs: DataFrame, limit: int = 400_000) -> DataFrame:
    """(word, c) of all rows; a task holds about ``limit`` words at a time. The end is the empty word."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in slices(batches, "text", 1 << 20):
            for t in batch.column("text").to_pylist():
                held.update(words(t))
            held[END] += batch.num_rows
            if len(held) > limit:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], schema=schema)
                held = Counter()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], schema=schema)

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """What is kept of the words' counts: a table, the head of it, and sums."""

    rare: DataFrame  # (word, c) of the words that aren't in head
    head: dict[bytes, int]  # number of each frequent word
    seen: np.ndarray  # their counts
    classes: np.ndarray  # their classes
    n: int  # training tokens
    v: int  # distinct ones
    tokens: np.ndarray  # training tokens of each class
    kinds: np.ndarray  # distinct ones

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the unigram model for words with these counts."""
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))

    def within(self, c: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 P(word | class); a class of one word is that word."""
        share = np.log10((c + 0.5) / (self.tokens[classes] + 0.5 * (self.kinds[classes] + 1)))
        return np.where(classes <= OWN, 0.0, share)


def lexicon(train: DataFrame) -> Lexicon:
    counts = materialize(count_words(train).withColumn("level", F.floor(F.log2("c") * 8).cast("int")), "words")
    # Counts by level, eight to a doubling: as many whole levels of frequent words as LEXICON holds.
    levels = {r.level: (r.words, r.tokens) for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("words"), F.sum("c").alias("tokens")).collect()}
    room, least = LEXICON, 1 << 30
    for level in sorted(levels, reverse=True):
        room -= levels[level][0]
        if room < 0:
            break
        least = level
    rows = sorted(((bytes(r.word), r.c) for r in counts.where(F.col("level") >= least).select("word", "c").collect()), key=lambda r: (r[0] != END, -r[1], r[0]))
    if not rows or rows[0][0] != END:  # the end is always class 0, also if it is rare or unseen
        end = counts.where(F.col("word") == F.lit(END)).first()
        rows.insert(0, (END, end.c if end else 0))
    rare = counts.where((F.col("level") < least) & (F.col("word") != F.lit(END))).select("word", "c")
    classes = np.array([i if i <= OWN else shared_class(w) for i, (w, _) in enumerate(rows)], np.int64)
    seen = np.array([c for _, c in rows], np.int64)
    tokens, kinds = np.zeros((2, CLASSES))
    np.add.at(tokens, classes, seen)
    np.add.at(kinds, classes, seen > 0)
    by_class = rare.groupBy(F.expr(f"{1 + OWN} + crc32(substring(word, -3)) % {SHARED}").alias("k")).agg(F.count(F.lit(1)).alias("words"), F.sum("c").alias("tokens"))
    for r in by_class.collect():  # SHARED rows at most
        tokens[r.k] += r.tokens
        kinds[r.k] += r.words
    return Lexicon(rare, {w: i for i, (w, _) in enumerate(rows)}, seen, classes, sum(t for _, t in levels.values()), sum(k for k, _ in levels.values()), tokens, kinds)


def encode(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """Each text as its classes (u16), the sums of its frequent words, and a list of the others."""
    shared = docs.sparkSession.sparkContext.broadcast((lex.head, lex.classes, lex.base(lex.seen), lex.within(lex.seen, lex.classes), lex.seen > 0))
    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("classes", pa.binary()), ("known", pa.int64()), ("base", pa.float64()), ("within", pa.float64()), ("others", pa.list_(pa.binary()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, classes, base, within, seen = shared.value
        for batch in slices(batches, "text", 1 << 20):
            out = []
            for t in batch.column("text").to_pylist():
                tokens = words(t)
                tokens.append(END)
                at = np.array([head.get(w, -1) for w in tokens], np.int64)
                there = at >= 0
                k = classes[at]
                others = [tokens[i] for i in np.flatnonzero(~there)]
                k[~there] = [shared_class(w) for w in others]
                at = at[there]
                out.append((len(tokens), k.astype("<u2").tobytes(), int(seen[at].sum()), float(base[at].sum()), float(within[at].sum()), others))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *[pa.array(c, t) for c, (_, t) in zip(columns, fields[2:])]], schema=pa.schema(fields))

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, classes binary, known long, base double, within double, others array<binary>")


class Ragged:
    """Sequences side by side: step t holds the t-th class of those longer than t, longest first."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        self.order = np.argsort([-len(s) for s in sequences], kind="stable")
        lengths = np.array([len(sequences[i]) for i in self.order], np.int64)
        self.active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right") if len(lengths) else np.zeros(0, np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.active)])
        place = np.concatenate([self.at[: n] + d for d, n in enumerate(lengths)]) if len(lengths) else np.zeros(0, np.int64)
        self.classes = np.empty(len(place), np.int64)
        self.classes[place] = np.concatenate([sequences[i] for i in self.order]) if len(lengths) else 0


@dataclass
class Model:
    first: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


def expected(model: Model, sequences: list[np.ndarray], fresh: np.ndarray) -> np.ndarray:
    """Expected counts (emissions, moves, first states) and the log-likelihood, by scaled forward and backward recursions.

    ``fresh``: whether a sequence begins a text; only these count for first states.
    """
    r = Ragged(sequences)
    move, seen = model.move.astype(np.float32), model.emit.astype(np.float32)[r.classes]
    alpha, scale = np.empty_like(seen), np.empty(len(seen), np.float32)
    now = np.repeat(model.first.astype(np.float32)[None], len(sequences), 0)
    for t, n in enumerate(r.active):
        a, b = r.at[t], r.at[t + 1]
        now = (now if t == 0 else now[:n] @ move) * seen[a:b]
        scale[a:b] = now.sum(1)
        now /= scale[a:b, None]
        alpha[a:b] = now
    moves = np.zeros((STATES, STATES))
    seen /= scale[:, None]
    beta = np.ones((0, STATES), np.float32)
    for t in range(len(r.active) - 1, -1, -1):
        a, b, n = r.at[t], r.at[t + 1], len(beta)
        here = np.ones((b - a, STATES), np.float32)
        if n:
            later = seen[b : b + n] * beta
            moves += alpha[a : a + n].T @ later
            here[:n] = later @ move.T
        alpha[a:b] *= here
        beta = here
    emitted = np.stack([np.bincount(r.classes, alpha[:, s], CLASSES) for s in range(STATES)], 1)
    first = alpha[: len(sequences)][fresh[r.order]].sum(0)
    return np.concatenate([emitted.ravel(), (moves * model.move).ravel(), first, [np.log(scale, dtype=float).sum()]])


def log_likelihood(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """The exact natural log-likelihood of each sequence, however long, by the scaled forward recursion."""
    r = Ragged(sequences)
    total, now = np.zeros(len(sequences)), np.repeat(model.first[None], len(sequences), 0)
    for t, n in enumerate(r.active):
        now = (now if t == 0 else now[:n] @ model.move) * model.emit[r.classes[r.at[t] : r.at[t + 1]]]
        c = now.sum(1)
        now /= c[:, None]
        total[:n] += np.log(c)
    out = np.empty(len(sequences))
    out[r.order] = total
    return out


def baum_welch(encoded: DataFrame, lex: Lexicon, seed: int = 11) -> Model:
    """Fit on all rows of ``encoded``, ROUNDS times all of them.

    States start alike but for seeded noise in what they emit, and tend to
    stay. Texts are taken in segments, which keeps tasks' memory bounded; a
    later segment starts from the first states' distribution too.
    """
    even = (lex.tokens + 0.5) / (lex.tokens.sum() + 0.5 * CLASSES)
    emit = even[:, None] * np.random.default_rng(seed).uniform(0.5, 1.5, (CLASSES, STATES))
    model = Model(np.full(STATES, 1 / STATES), np.full((STATES, STATES), 0.1 / (STATES - 1)), emit / emit.sum(0))
    np.fill_diagonal(model.move, 0.9)
    cells = CLASSES * STATES
    for _ in range(ROUNDS):
        shared = encoded.sparkSession.sparkContext.broadcast(model)

        def one(batch: pa.RecordBatch) -> np.ndarray:
            texts = [np.frombuffer(b, "<u2") for b in batch.column("classes").to_pylist()]
            cut = [(t[i : i + SEGMENT], i == 0) for t in texts for i in range(0, len(t), SEGMENT)]
            return expected(shared.value, [s for s, _ in cut], np.array([f for _, f in cut], bool))

        got = summed(encoded.select("classes"), "classes", one, cells + STATES * STATES + STATES + 1, max_bytes=1 << 20)
        emitted, moves, first = got[:cells].reshape(CLASSES, STATES), got[cells : cells + STATES * STATES].reshape(STATES, STATES), got[-STATES - 1 : -1]
        model = Model((first + 0.1) / (first + 0.1).sum(), (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True), (emitted + 5 * even[:, None]) / (emitted.sum(0) + 5))
        shared.destroy()
    return model


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    The model learns from all rows where ``held_out`` is false (null counts as
    false). A null or empty text is its end alone. With nothing to learn from,
    counts are 0, and every class is as likely as any other.
    """
    spark = docs.sparkSession
    docs = documents(docs.withColumn("held_out", F.coalesce(held_out, F.lit(False))), "held_out").withColumn("held_out", F.col("held_out").cast("boolean"))
    lex = lexicon(docs.where(~F.col("held_out")))
    encoded = materialize(encode(docs, lex).withColumn("row", F.monotonically_increasing_id()), "classes")
    shared = spark.sparkContext.broadcast(baum_welch(encoded.where(~F.col("held_out")), lex))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "classes", 1 << 19):
            logs = log_likelihood(shared.value, [np.frombuffer(b, "<u2") for b in batch.column("classes").to_pylist()]) / np.log(10)
            keep = [c for c in batch.schema.names if c != "classes"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(logs)], [*keep, "chain"])

    scored = encoded.drop("others").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, known long, base double, within double, row long, chain double")

    # The other words meet their counts; one that training never saw has none.
    spread = encoded.select("row", F.explode("others").alias("word"))
    table = spark.createDataFrame([(k, float(lex.tokens[k] + 0.5 * (lex.kinds[k] + 1))) for k in range(1 + OWN, CLASSES)], "k int, room double")
    c = F.coalesce("c", F.lit(0))
    met = spread.join(lex.rare, "word", "left").withColumn("k", F.expr(f"{1 + OWN} + crc32(substring(word, -3)) % {SHARED}").cast("int")).join(F.broadcast(table), "k")
    rest = met.groupBy("row").agg(F.count("c").alias("known_"), F.sum(F.log10((c + 0.5) / (lex.n + 0.5 * (lex.v + 1)))).alias("base_"), F.sum(F.log10((c + 0.5) / F.col("room"))).alias("within_"))
    zero = lambda name: F.coalesce(name, F.lit(0.0))
    return scored.join(rest, "row", "left").select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known_", F.lit(0))).alias("n_known"), F.lit(lex.n).cast("long").alias("train_tokens"),
                                                   (F.col("base") + zero("base_")).alias("base_score"), (F.col("chain") + F.col("within") + zero("within_")).alias("score"))
