"""Periodic runs by online dyadic square catching (operator 11).

A square is a stretch of words twice in a row; squares of one period that
overlap merge into a run. Words are appended to ``Catchers``. Once a block of
2^k words is complete a catcher watches it: a square that starts in the block,
with a period p in (2^k, 2^(k+1)], covers the word after the block, the anchor,
and its copy p words on. So every appended word is compared, with the word
before it, to the anchor of one catcher of each level. Where both agree, a
comparison of the two suffixes opens: it looks back to the start of the run
(in the block, or the run belongs to the catcher of an earlier block) and goes
on with each appended word until the words differ. If it got as far as two
periods, a run is reported. A run of a shorter period that already covers
the words from the anchor to its copy, a whole number of times, keeps squares
of that shorter period from being caught again.

All comparisons that a stretch of appended words can advance are made as one
vector; the runs don't depend on how the words are cut into stretches.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, slices

STEPS = 24  # words a vector of comparisons advances before the few that are left go on alone


class Catchers:
    """Finds the runs of a growing sequence of numbers; ``longest``: the greatest period looked for."""

    def __init__(self, longest: int | None = None) -> None:
        self.words, self.n, self.longest = np.zeros(1 << 10, np.int64), 0, longest
        self.open: list[tuple[int, int]] = []  # (start, period) of comparisons that hold to the last word
        self.runs: list[tuple[int, int, int]] = []  # (start, length, period) of ended runs

    def differ(self, at: np.ndarray, period: np.ndarray, step: int, last: np.ndarray) -> np.ndarray:
        """For each item the first place from ``at`` on, in steps of 1 or -1, whose word isn't that of one period
        before (after, if stepping back); ``last``, which is not compared, if there is none."""
        t, at, alive = self.words, at.copy(), np.arange(len(at))
        for _ in range(STEPS):
            alive = alive[at[alive] != last[alive]]
            alive = alive[t[at[alive]] == t[at[alive] - step * period[alive]]]
            if not len(alive):
                return at
            at[alive] += step
        for i in alive.tolist():
            x, p, end, size = int(at[i]), int(period[i]), int(last[i]), 64
            while x != end:
                size = min(2 * size, abs(end - x))
                here = t[x : x + size] if step > 0 else t[x - size + 1 : x + 1][::-1]
                there = t[x - p : x - p + size] if step > 0 else t[x + p - size + 1 : x + p + 1][::-1]
                same = here == there
                if not same.all():
                    x += step * int(same.argmin())
                    break
                x += step * size
            at[i] = x
        return at

    def follow(self, start: np.ndarray, at: np.ndarray, period: np.ndarray, live: list[tuple[int, int, int]]) -> None:
        """Advance comparisons that hold up to the word before ``at``; what ends, or stays open, also goes to ``live``."""
        ends = self.differ(at, period, 1, np.full(len(at), self.n))
        for s, e, p in zip(start.tolist(), ends.tolist(), period.tolist()):
            if e == self.n:
                self.open.append((s, p))
            elif e - s >= 2 * p:
                self.runs.append((s, e - s, p))
            if e - s >= 2 * p:
                live.append((s, e, p))

    def append(self, more: np.ndarray) -> None:
        old, n = self.n, self.n + len(more)
        if n > len(self.words):
            self.words = np.concatenate([self.words[:old], np.zeros(n, np.int64)])
        self.words[old:n], self.n = more, n
        t, live = self.words, []  # live: (start, end, period) of runs that reach into these words
        held = np.array(self.open, np.int64).reshape(-1, 2)
        self.open = []
        self.follow(held[:, 0], np.full(len(held), old), held[:, 1], live)
        # Period 1: the block is one word, its copy the next.
        x = np.arange(max(old, 1), n)
        same = t[x] == t[x - 1]
        first = x[same & ((x < 2) | (t[x - 1] != t[x - 2]))]
        self.follow(first - 1, first + 1, np.ones(len(first), np.int64), live)
        k = 0
        while (2 << k) + 1 < n and (self.longest is None or (1 << k) < self.longest):
            self.catch(k, max(old, (2 << k) + 1), live)
            k += 1

    def catch(self, k: int, since: int, live: list[tuple[int, int, int]]) -> None:
        """What the catchers of level ``k`` find as the words from ``since`` on come."""
        t, size = self.words, 1 << k
        x = np.arange(since, self.n)
        anchor = (((x - 1) >> k) - 1) << k
        hit = t[x] == t[anchor]
        x, anchor = x[hit], anchor[hit]
        hit = t[x - 1] == t[anchor - 1]
        x, anchor = x[hit], anchor[hit]
        period = x - anchor
        for s, e, p in live:
            if e - s > size and len(x):
                lo, hi = np.searchsorted(anchor, [s, e])
                covered = (x[lo:hi] <= e) & (period[lo:hi] % p == 0)
                if covered.any():
                    keep = np.ones(len(x), bool)
                    keep[lo:hi] = ~covered
                    x, anchor, period = x[keep], anchor[keep], period[keep]
        if not len(x):
            return
        # Back to where the run starts, if that is in the block.
        edge = np.maximum(anchor - size - 2, -1)
        start = self.differ(anchor - 1, period, -1, edge) + 1
        mine = start >= anchor - size
        x, period, start = x[mine], period[mine], start[mine]
        # The last word that a square needs, where it is there already, ends most comparisons at once.
        far = start + 2 * period - 1
        there = far < self.n
        far = np.where(there, far, 0)
        good = ~there | (t[far] == t[far - np.where(there, period, 0)])
        self.follow(start[good], x[good], period[good], live)

    def found(self, least: int = 2) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs of ``least`` words or more so far, by start, then period."""
        some = self.runs + [(s, self.n - s, p) for s, p in self.open if self.n - s >= 2 * p]
        return sorted((r for r in some if r[1] >= least), key=lambda r: (r[0], r[2]))


def repeating(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words that for every tenth document, by the crc32 of its id, repeat a stretch from some word on. For ``runs``' ``rewrite``."""
    n, (g, rest) = len(words), divmod(zlib.crc32(str(doc_id).encode()), 10)
    if doc_id is None or rest or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def runs(docs: DataFrame, least: int = 12, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs array<struct<start, length, period>>, collapsed), one row for each row of ``docs``.

    Runs are those of ``least`` words or more, by start and then period, in
    places of words (from 0). ``collapsed`` holds the words, joined by one
    space, that no run has after its first period. ``rewrite`` may change the words (UTF-8) of a document before.
    A null or blank text has no words, no runs and an empty ``collapsed``; rows
    that repeat are found again; other columns are left out.

    The texts of a slice go to one sequence with a mark of its own after each,
    which no run can cross.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            ids = batch.column("doc_id").to_pylist()
            texts = [t.encode().split() for t in batch.column("text").to_pylist()]  # of bytes: ASCII white space only
            if rewrite:
                texts = [rewrite(i, w) for i, w in zip(ids, texts)]
            sizes = np.array([len(w) for w in texts], np.int64)
            known: dict[bytes, int] = {}
            for words in texts:
                for w in dict.fromkeys(words):
                    known.setdefault(w, len(known))
            whole = np.empty(int(sizes.sum()) + len(texts), np.int64)
            begins = np.concatenate([[0], np.cumsum(sizes + 1)])
            for d, words in enumerate(texts):
                whole[begins[d] : begins[d] + sizes[d]] = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                whole[begins[d + 1] - 1] = -1 - d
            catchers = Catchers(int(sizes.max(initial=0)) // 2)
            catchers.append(whole)
            out: list[list[dict]] = [[] for _ in texts]
            keep = np.ones(len(whole), bool)
            found = catchers.found(least)
            for d, (s, length, p) in zip((np.searchsorted(begins, [r[0] for r in found], "right") - 1).tolist(), found):
                out[d].append({"start": s - int(begins[d]), "length": length, "period": p})
                keep[s + p : s + length] = False
            left = [b" ".join([w for w, k in zip(words, keep[begins[d] : begins[d + 1]].tolist()) if k] if out[d] else words).decode() if words else "" for d, words in enumerate(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, schema.types[1]), pa.array(left, pa.string())], schema=schema)

    return documents(docs).mapInArrow(run, "doc_id long, runs array<struct<start long, length long, period long>>, collapsed string")
