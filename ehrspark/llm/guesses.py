"""Secrets by pattern and by guess cost (operator 12).

The base is three patterns. The method adds values that stand where a
credential would (``password: ...``, ``client_secret = ...``, ``user:...@``)
and are hard to guess: a dynamic programme cuts the value into words, dates,
repeats, keyboard walks and brute-force spans so that the logarithms of
the guesses that each needs add up to the least. A value that takes 10^least
guesses or more is a secret; words and sample values such as
``password123`` take fewer.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, slices
from .squares import Catchers

KINDS = ("assign", "access", "hex", "guess")
#: The base. Of UTF-8 bytes, so that only ASCII letters have two cases.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")  # a shorter run of hex digits would be dropped
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
#: Where else a credential stands: after its name, or before the host of an address.
NAMED = re.compile(rb"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|signing|encryption)[_-]?key|auth(?:orization)?|bearer|credentials?)["']?\s{0,8}(?:=>|:=|[:=]|\sis\s)\s{0,8}(?:(?:bearer|basic)\s)?["']?([^\s"'<>]+)""", re.IGNORECASE)
ADDRESS = re.compile(rb"://[^\s/:@]{1,256}:([^\s/@]+)@")
TRAIL = b".,;:!?)]}"

LONGEST_WORD, LONGEST_WALK = 24, 40  # characters of a word or keyboard-walk span; what is longer takes several
JOIN = math.log10(2)  # one more span
#: Keyboard rows, each half a key to the right of the one above it, plain and with the shift key.
ROWS = [("`1234567890-=", "~!@#$%^&*()_+"), (" qwertyuiop[]\\", " QWERTYUIOP{}|"), (" asdfghjkl;'", ' ASDFGHJKL:"'), (" zxcvbnm,./", " ZXCVBNM<>?")]
KEY = {c: (x, y) for y, row in enumerate(ROWS) for line in row for x, c in enumerate(line) if c != " "}
MOVES = {(-1, 0), (1, 0), (0, -1), (1, -1), (0, 1), (-1, 1)}
KEYS, DEGREE = 47, 4.6  # keys, and neighbours of a key on average
#: What digits and signs stand for in words; 1 and ! for two letters.
LEET = [str.maketrans("4@8361!0$57+2", f"aabeg{i}{i}ossttz") for i in "il"]
DATE = re.compile(r"(?:(?P<a>\d{1,2})(?P<s>[-/._ ]?)(?P<b>\d{1,2})(?P=s)(?P<y>(?:19|20)\d\d|\d\d)|(?P<y2>(?:19|20)\d\d)(?P<s2>[-/._ ]?)(?P<a2>\d{1,2})(?P=s2)(?P<b2>\d{1,2}))")
YEAR = re.compile(r"(?:19|20)\d\d")


@cache
def ranks(path: str) -> dict[str, int]:
    """Whole words of a public vocabulary file by rank: it lists what was merged first, the most frequent, first."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    words = sorted((i, t[:-4]) for t, i in vocabulary.items() if t.endswith("</w>") and len(t) > 6 and t[:-4].isalpha())
    return {w: k for k, (_, w) in enumerate(words, 1)}


def size(c: str) -> float:
    """log10 of how many characters a guesser tries for one like ``c``."""
    return math.log10(10 if c in "0123456789" else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100)


def word_cost(word: str, rank: int, leet: bool) -> float:
    """A word's rank, times two for each way it is written otherwise, and the choices of its capitals."""
    upper, out = sum(c.isupper() for c in word), math.log10(rank)
    if upper:
        plain = word[0].isupper() and upper == 1 or word.isupper()
        out += math.log10(2) if plain else math.log10(sum(math.comb(len(word), k) for k in range(1, min(upper, len(word) - upper) + 1)) + 1)
    return out + math.log10(2) * len({c for c in word if not c.isalpha()}) if leet else out


def spans_from(value: str, known: dict[str, int]) -> list[list[tuple[int, float]]]:
    """For each place the (end, cost) of the words, dates, repeats and keyboard walks that start there."""
    n = len(value)
    out: list[list[tuple[int, float]]] = [[] for _ in value]
    lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    texts = [lower, *dict.fromkeys(lower.translate(table) for table in LEET)]
    texts = texts[:1] + [t for t in texts[1:] if t != lower]
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            best = min((word_cost(value[i:j], known[w], k > 0 and w != lower[i:j]) for k, t in enumerate(texts) if (w := t[i:j]) in known), default=None)
            if best is not None:
                out[i].append((j, best))
        if value[i].isdecimal() and value[i].isascii():
            for rule in (DATE, YEAR):
                if m := rule.match(value, i):
                    got = m.groupdict()
                    if rule is DATE:
                        a, b = int(got["a"] or got["a2"]), int(got["b"] or got["b2"])
                        if not (1 <= min(a, b) <= 12 and 1 <= max(a, b) <= 31):
                            continue
                        year, sign = got["y"] or got["y2"], got["s"] or got["s2"]
                    else:
                        year, sign = m[0], ""
                    away = max(20, abs(int(year) - 2000) if len(year) == 4 else 0)
                    out[i].append((m.end(), math.log10(away * (365 if rule is DATE else 1) * (4 if sign else 1))))
        step, turns, j = None, 0, i + 1
        while j < min(n, i + LONGEST_WALK) and value[j] in KEY and value[j - 1] in KEY:
            move = (KEY[value[j]][0] - KEY[value[j - 1]][0], KEY[value[j]][1] - KEY[value[j - 1]][1])
            if move not in MOVES:
                break
            turns += move != step
            step, j = move, j + 1
            if j - i >= 3:
                out[i].append((j, math.log10(KEYS * (j - i)) + turns * math.log10(DEGREE)))
    letters = Catchers()
    letters.append(np.array([ord(c) for c in value], np.int64))
    for start, length, period in letters.found(3):
        out[start].append((start + length, cost(value[start : start + period], known) + math.log10(length / period)))
    return out


def cost(value: str, known: dict[str, int]) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes; 0 if it is empty."""
    n = len(value)
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    starts = spans_from(value, known)
    for i, c in enumerate(value):
        join = JOIN if i else 0.0
        brute[i + 1] = min(brute[i], best[i] + join) + size(c)
        best[i + 1] = min(best[i + 1], brute[i + 1])
        for end, one in starts[i]:
            best[end] = min(best[end], best[i] + join + one)
    return best[n]


def secrets(text: str, known: dict[str, int], least: float, shortest: int) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, cost) of a text's spans, in code points, by start and then kind."""
    raw = text.encode()
    found: list[tuple[int, int, int, int, int]] = []  # start, kind, end, and where the value is
    low = raw.lower()
    if any(w in low for w in (b"passw", b"secret", b"token", b"key")):
        found += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(raw)]
    base = sorted((s, e) for s, _, e, _, _ in found)
    values = set()
    if any(w in low for w in (b"pass", b"pwd", b"secret", b"token", b"key", b"auth", b"bearer", b"credential")):
        values |= {m.span(1) for m in NAMED.finditer(raw)}
    if b"://" in raw:
        values |= {m.span(1) for m in ADDRESS.finditer(raw)}
    ends, far = [], 0  # base spans by start, each with the farthest end so far
    for _, e in base:
        far = max(far, e)
        ends.append(far)
    begins = np.array([s for s, _ in base], np.int64)
    for s, e in values:
        e = s + len(raw[s:e].rstrip(TRAIL))
        inside = int(np.searchsorted(begins, s, "right")) - 1
        if e - s < shortest or inside >= 0 and ends[inside] >= e:
            continue
        if cost(raw[s:e].decode(), known) >= least:
            found.append((s, 3, e, s, e))
    if not found:
        return []
    found = sorted(set(found))
    if len(raw) == len(text):
        place = range(len(raw) + 1)
    else:
        place = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(KINDS[k], int(place[s]), int(place[e]), cost(raw[a:b].decode(), known)) for s, k, e, a, b in found]


def scan(docs: DataFrame, vocabulary: str, least: float = 8.0, shortest: int = 6) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, cost>>), one row for each row of ``docs``.

    Places are code points, the end exclusive; spans are sorted by start, then
    in the order of ``KINDS``. ``cost`` is log10 of the guesses that the value
    takes. A span of the base is one match of its pattern; a ``guess`` is a
    value of ``shortest`` bytes or more that takes 10^``least`` guesses and
    doesn't lie within a span of the base. ``vocabulary``: a tokenizer file
    whose words, by rank, are the guesser's dictionary. A null or empty text
    has no spans; rows that repeat are scanned again; other columns are left out.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranks(vocabulary)
        for batch in slices(batches, "text", 4 << 20):
            spans = [[dict(zip(("kind", "start", "end", "cost"), s)) for s in secrets(t, known, least, shortest)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, schema.types[1])], schema=schema)

    return documents(docs).mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, end long, cost double>>")
