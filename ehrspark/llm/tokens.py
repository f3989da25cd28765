"""Tokenising with a public vocabulary file, once for each distinct chunk of text."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa

from .common import DROPS, EVERY_SPACE, claim

#: Both vocabularies split a text at white space, and between letters and
#: commas or full stops, before they merge pairs, so the ids of a text are the
#: ids of these chunks, one after another. The byte vocabulary keeps white
#: space: one space goes to the word after it, of a longer run all but the
#: last character stand alone.
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
#: What a character is, for those up to the last white space.
OTHER, SPACE, LETTER, STOP, END = range(5)
KIND = np.zeros(0x3002, np.uint8)
KIND[[c for c in range(0x3001) if re.match(f"[{EVERY_SPACE}]", chr(c))]] = SPACE
KIND[[c for c in range(0x100) if re.match(LETTERS, chr(c))]] = LETTER
KIND[[ord(","), ord(".")]] = STOP
NARROW = KIND[:0x100].tobytes()
PART = 1 << 20  # characters that are cut at once
SAFE = re.compile(f"(?<=[^{EVERY_SPACE}]) (?=[^{EVERY_SPACE}])")  # before such a space a chunk ends


def parts(text: str) -> list[str]:
    """A very long text in parts that break no chunk (one, if it has no place for it)."""
    out, start = [], 0
    while len(text) - start > PART and (cut := SAFE.search(text, start + PART)):
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups that are cut at once, of about ``PART`` characters at most where they are short."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > PART:
            yield texts[start:i]
            start, size = i, 0
        size += len(t)
    if texts:
        yield texts[start:]


def chunks(texts: list[str], spaces: bool) -> tuple[pa.BinaryArray, np.ndarray]:
    """The chunks of all texts, and where in them each text begins, and the end.

    ``spaces``: the rule of the byte vocabulary; otherwise white space is left out.
    """
    lengths = [len(t) + 1 for t in texts]
    begins = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    ends, joined = begins[1:] - 1, "\0".join([*texts, ""])  # after each text, of no bytes
    count = np.int32 if 4 * len(joined) < 1 << 31 else np.int64
    try:
        raw = joined.encode("latin-1")
        code, kind = np.frombuffer(raw, np.uint8), np.frombuffer(bytearray(raw.translate(NARROW)), np.uint8)
        width = (code >= 0x80).view(np.uint8) + np.uint8(1)
    except UnicodeEncodeError:
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kind = KIND[np.minimum(code, 0x3001)]
        width = 1 + (code >= 0x80).astype(np.uint8) + (code >= 0x800) + (code >= 0x10000)
    kind[ends] = END
    width[ends] = 0
    place = np.zeros(len(joined) + 1, count)
    np.cumsum(width, out=place[1:])

    solid = (kind != SPACE) & (kind != END)
    blank = kind == SPACE
    before = lambda x: np.concatenate([[False], x[:-1]])
    word = np.flatnonzero(solid & ~before(solid))  # the first characters of runs without white space
    mark = blank & ~before(blank)
    mark[ends] = True
    mark[word] = True
    # Letters that a comma or full stop follows are a chunk, what comes after them another.
    no_letter = np.flatnonzero(kind != LETTER)
    stop = no_letter[np.searchsorted(no_letter, word)] if len(word) else word
    stop = stop[(stop > word) & (kind[stop] == STOP)]
    mark[stop] = True
    if spaces:
        last = word[word > 0] - 1
        last = last[blank[last]]  # the last character of the white space before a word
        mark[last] = True
        mark[last[code[last] == 32] + 1] = False  # one space goes with the word
    first = np.flatnonzero(mark)
    offsets = np.append(place[first], place[-1]).astype(np.int32)
    held = (kind[first] != END) & (True if spaces else kind[first] != SPACE)
    data = "".join(texts).encode()
    found = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).filter(pa.array(held))
    return found, np.searchsorted(first[held], begins)


#: Chunks that can be encoded in one text, and how to tell them apart after:
#: by tokens that end a word, or that begin with the space before it.
TOGETHER = {"word": ("^[a-zß-öø-ÿ]+$", " ", lambda token: token.endswith("</w>")), "byte": (f"^ [^{EVERY_SPACE}]+$", "", lambda token: token.startswith("Ġ"))}


def only_words(path: str) -> str:
    """The vocabulary file with the steps that change plain words in lower case alone: cut at spaces, bytes to symbols, merges."""
    held = json.loads(Path(path).read_text())
    symbols = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    steps = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, symbols]}
    return json.dumps(held | {"normalizer": None, "added_tokens": [], "post_processor": None, "pre_tokenizer": steps})


def small(text: str) -> str:
    """``text`` in lower case if that can't depend on how the library orders its steps."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def encoded(tokenizer, texts: Iterator[str], n: int) -> Iterator[np.ndarray]:
    """The ids of each text, ``n`` texts at once: what the library holds of a text is many times its ids."""
    while some := list(islice(texts, n)):
        for e in tokenizer.encode_batch_fast(some, add_special_tokens=False):
            yield np.array(e.ids, "<u4")


class ChunkEncoder:
    """``tokenizers`` with a bounded memory of the chunks it has met.

    ``kind`` names the chunk rule that suits the vocabulary. A text that holds
    the string of an added token is encoded whole. At most ``keep`` chunks of up to
    ``longest`` bytes are remembered; beyond that the less frequent ones go.
    They are Arrow and numpy columns: ``names``, where in ``ids`` the ids of each are, and how often it was met.
    """

    def __init__(self, path: str, kind: str, keep: int = 200_000, longest: int = 48) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.IGNORECASE)
        self.spaces, self.keep, self.longest = kind == "byte", keep, longest
        self.names, self.ids = pa.array([], pa.binary()), np.zeros(0, "<u4")
        self.at = self.sizes = self.met = np.zeros(0, np.int64)
        self.lower = kind == "word"  # this vocabulary has no upper case
        self.plain, self.glue, edge = TOGETHER[kind]
        self.words = Tokenizer.from_str(only_words(path)) if self.lower else self.tokenizer
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for token, i in vocabulary.items() if edge(token)]] = True

    def fresh(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each chunk begin, how many they are, and all ids.

        Plain words are encoded many at a time, others, or a group that doesn't come apart, one by one.
        """
        names, plain = chunks.to_pylist(), pa.compute.match_substring_regex(chunks, self.plain).to_numpy(zero_copy_only=False)
        together = np.flatnonzero(plain)
        some = [together[i : i + 32] for i in range(0, len(together), 32)]
        single, order, sizes, ids = [np.flatnonzero(~plain)], [], [], []
        for group, its in zip(some, encoded(self.words, (self.glue.join([names[i] for i in g.tolist()]) for g in some), 64)):
            edges = np.flatnonzero(self.edge[its]) + (1 if self.glue else 0)
            if len(edges) != len(group):
                single.append(group)
                continue
            order.append(group)
            sizes.append(np.diff(edges, prepend=0) if self.glue else np.diff(edges, append=len(its)))
            ids.append(its)
        rest = np.concatenate(single)
        found = list(encoded(self.tokenizer, (names[i] for i in rest.tolist()), 1024))
        order, sizes = np.concatenate([*order, rest]), np.concatenate([*sizes, np.fromiter(map(len, found), np.int64, len(found))])
        at, many = np.zeros((2, len(names)), np.int64)
        at[order], many[order] = np.cumsum(sizes) - sizes, sizes
        return at, many, np.concatenate([np.zeros(0, "<u4"), *ids, *found])

    def remember(self, names: pa.BinaryArray, at: np.ndarray, sizes: np.ndarray, ids: np.ndarray, met: np.ndarray) -> None:
        """Chunks met first now, with what ``fresh`` found."""
        short = pa.compute.binary_length(names).to_numpy(zero_copy_only=False) <= self.longest
        self.names = pa.concat_arrays([self.names, names.filter(pa.array(short))])
        self.ids = np.concatenate([self.ids, spread(ids, at[short], sizes[short])])
        self.sizes, self.met = np.concatenate([self.sizes, sizes[short]]), np.concatenate([self.met, met[short]])
        if len(self.names) > self.keep:
            best = np.sort(np.argsort(-self.met, kind="stable")[: self.keep * 3 // 4])
            self.ids = spread(self.ids, (np.cumsum(self.sizes) - self.sizes)[best], self.sizes[best])
            self.names, self.sizes, self.met = self.names.take(pa.array(best)), self.sizes[best], self.met[best] // 2
        self.at = np.cumsum(self.sizes) - self.sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        whole = [i for i, t in enumerate(texts) if self.added.search(t)]
        special = {i: array("I", e.ids).tobytes() for i, e in zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False))}
        texts = ["" if i in special else t for i, t in enumerate(texts)]
        if self.lower:
            texts = [small(t) for t in texts]
        cut = [parts(t) for t in texts]
        some = [chunks(ps, self.spaces) for ps in groups([p for c in cut for p in c])]
        shifts = np.cumsum([0, *(len(f) for f, _ in some)])
        begins = np.concatenate([*(b[:-1] + n for (_, b), n in zip(some, shifts)), shifts[-1:]])
        found = pa.concat_arrays([pa.array([], pa.binary()), *(f for f, _ in some)]).dictionary_encode()
        words, which = found.dictionary, found.indices.to_numpy()
        known = pa.compute.index_in(words, value_set=self.names).fill_null(-1).to_numpy()
        old, new = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
        names = words.take(pa.array(new))
        first, n, ids = self.fresh(names.cast(pa.string()))
        at, sizes = np.zeros((2, len(words)), np.int64)
        at[old], sizes[old] = self.at[known[old]], self.sizes[known[old]]
        at[new], sizes[new] = first + len(self.ids), n
        met = np.bincount(which, minlength=len(words))
        self.met[known[old]] += met[old]
        # Ids of all chunks, taken from those of the distinct ones, group by group.
        ends = np.concatenate([[0], np.cumsum(sizes[which])])
        held = np.concatenate([self.ids, ids])
        flat = np.concatenate([held[:0], *(spread(held, at[w], sizes[w]) for w in (which[a:b] for a, b in zip(shifts, shifts[1:])))])
        self.remember(names, first, n, ids, met[new])
        pieces = np.cumsum([0, *map(len, cut)])  # where the parts of each text begin
        bounds = ends[begins[pieces]].tolist()
        return [special[i] if i in special else flat[a:b].tobytes() for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]


def spread(flat: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``at``, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(at - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


@cache
def held(path: str, kind: str) -> ChunkEncoder:
    return ChunkEncoder(path, kind)


DROPS["tokens"] = held.cache_clear


def encoder(path: str, kind: str) -> ChunkEncoder:
    """One encoder for each worker process, as long as no other operator's tasks run there."""
    claim("tokens")
    return held(path, kind)
