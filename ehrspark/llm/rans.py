"""Token ids in a static range asymmetric numeral system (operator 2).

The stream of all ids, in ascending document order, is cut into blocks that
are coded on their own against one shared frequency table. A dataset folder
holds two Parquet tables: ``table`` (symbol, freq; the freqs sum to 2**BITS)
and ``blocks``. A block row names its place (part, block), its documents'
pieces in order, its number of ids with their crc32, and ``payload``:

    header    <4sBBHIIII: magic, version, log2 lanes, checkpoints, ids,
              words, steps between checkpoints, crc32 of the rest
    states    lanes x u64 for each checkpoint; the first is the block's start
    places    u32 for each checkpoint: words read before it
    words     u32

Ids go to the lanes in turn, so a step decodes one id of each lane. A reader
may start at any checkpoint, and any block can be read without the others.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize
from .common import documents, slices
from .tokens import encoder

BITS, LOW = 20, np.uint64(1 << 31)
LANES, BLOCK, EVERY, TOGETHER = 32, 16_384, 128, 64
HEAD = struct.Struct("<4sBBHIIII")
PIECES = "array<struct<doc_id: bigint, seq: bigint, piece: int, n: bigint, whole: boolean>>"
BLOCKS = f"part int, block long, before long, n_ids long, ids_crc32 long, payload binary, pieces {PIECES}"


def frequencies(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and their shares of 2**BITS, at least 1 each and near the counts."""
    symbols = np.array(sorted(counts), np.int64)
    seen = np.array([counts[s] for s in symbols], float)
    if not len(symbols):
        return symbols, symbols
    freq = 1 + np.floor(seen / seen.sum() * ((1 << BITS) - len(symbols))).astype(np.int64)
    freq[np.argmax(freq)] += (1 << BITS) - freq.sum()
    return symbols, freq


class Coder:
    """The shared table, and blocks of ids to payloads and back, several at once."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray) -> None:
        self.symbols, self.freq = symbols, freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.full, self.rest = self.freq << np.uint64(63 - BITS), np.uint64(1 << BITS) - self.freq
        self.slot = np.repeat(np.arange(len(symbols), dtype=np.int32), freq)
        self.index = np.zeros(int(symbols.max()) + 1 if len(symbols) else 1, np.int32)
        self.index[symbols] = np.arange(len(symbols))

    def encode(self, blocks: list[np.ndarray]) -> list[bytes]:
        steps = max(-(-len(b) // LANES) for b in blocks)
        held = np.full((len(blocks), steps * LANES), -1, np.int32)
        for k, b in enumerate(blocks):
            held[k, : len(b)] = self.index[b]
        held = np.ascontiguousarray(held.reshape(len(blocks), steps, LANES).swapaxes(0, 1))  # by step
        gaps = (held < 0).any((1, 2))
        words, sent = np.zeros(held.shape, np.uint32), np.zeros(held.shape, bool)
        marks, state = {}, np.full((len(blocks), LANES), LOW, np.uint64)
        for t in range(steps - 1, -1, -1):
            s = held[t]
            out = state >= self.full.take(s, mode="wrap")
            if gaps[t]:
                out &= s >= 0
            words[t], sent[t] = state, out  # the low 32 bits
            x = state >> (out.view(np.uint8) << np.uint8(5))
            x += x // self.freq.take(s, mode="wrap") * self.rest.take(s, mode="wrap") + self.start.take(s, mode="wrap")
            state = np.where(s >= 0, x, state) if gaps[t] else x
            if t % EVERY == 0:
                marks[t] = state
        result = []
        for k, b in enumerate(blocks):
            n = max(1, -(-len(b) // LANES))
            at = [t for t in range(0, n, EVERY)]
            states = np.stack([marks[t][k] for t in at]) if steps else state[k : k + 1]
            before = np.concatenate([[0], np.cumsum(sent[:, k].sum(1))])[at].astype("<u4")
            stream = words[:, k][sent[:, k]].astype("<u4")
            rest = states.astype("<u8").tobytes() + before.tobytes() + stream.tobytes()
            result.append(HEAD.pack(b"RANS", 1, LANES.bit_length() - 1, len(at), len(b), len(stream), EVERY, zlib.crc32(rest)) + rest)
        return result

    def decode(self, payloads: list[bytes]) -> list[np.ndarray]:
        """The ids of each payload. Every checkpoint is the start of its own run
        of steps, so all runs of all blocks go forward side by side."""
        runs = []
        for k, p in enumerate(payloads):
            magic, version, lanes, marks, n, n_words, every, crc = HEAD.unpack_from(p)
            rest = memoryview(p)[HEAD.size :]
            if magic != b"RANS" or version != 1 or zlib.crc32(rest) != crc:
                raise ValueError("a block's payload is damaged")
            lanes = 1 << lanes
            states = np.frombuffer(rest, "<u8", marks * lanes).reshape(marks, lanes)
            places = np.frombuffer(rest, "<u4", marks, states.nbytes)
            stream = np.frombuffer(rest, "<u4", n_words, states.nbytes + places.nbytes)
            runs += [(k, states[j], stream[places[j] :], max(0, min(every * lanes, n - j * every * lanes))) for j in range(marks)]
        if not runs or not len(self.symbols):
            return [np.zeros(0, "<u4") for _ in payloads]
        size = max(r[3] for r in runs)
        lanes = len(runs[0][1])
        stream = np.concatenate([w[: r_n] for _, _, w, r_n in runs] + [np.zeros(lanes + 1, np.uint32)])
        at = np.cumsum([0] + [min(len(w), r_n) for _, _, w, r_n in runs])[:-1]
        state = np.stack([r[1] for r in runs]).astype(np.uint64)
        length = np.array([r[3] for r in runs])[:, None]
        out, lane = np.zeros((-(-size // lanes), len(runs), lanes), np.uint32), np.arange(lanes)
        symbols, least = self.symbols.astype(np.uint32), int(length.min())
        for t in range(len(out)):
            slot = state & np.uint64((1 << BITS) - 1)
            s = self.slot.take(slot.view(np.int64))
            out[t] = symbols.take(s)
            x = self.freq.take(s) * (state >> np.uint64(BITS)) + slot - self.start.take(s)
            need = x < LOW
            if (t + 1) * lanes > least:
                there = t * lanes + lane < length
                need &= there
                x = np.where(there, x, state)
            r, _ = np.nonzero(need)  # row by row, as the words lie
            counts = need.sum(1)
            words = stream[(at - np.cumsum(counts) + counts)[r] + np.arange(len(r))]
            x[need] = (x[need] << np.uint64(32)) | words
            state, at = x, at + counts
        out = out.swapaxes(0, 1)
        found: list[list[np.ndarray]] = [[] for _ in payloads]
        for (k, _, _, n), row in zip(runs, out.reshape(len(runs), -1)):
            found[k].append(row[:n])
        return [np.concatenate(f).astype("<u4") for f in found]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n, crc, ids): the ids of each text and ``end_id``, packed by zstd as u32 or, if they fit, u16.

    A null text is empty: its only id is ``end_id``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, end = zstandard.ZstdCompressor(level=1), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text", 4 << 20):
            raw = [b + end for b in encoder(tokenizer, "word").encode(batch.column("text").to_pylist())]
            packed = []
            for b in raw:
                ids = np.frombuffer(b, "<u4")
                packed.append(b"2" + squeeze.compress(ids.astype("<u2").tobytes()) if ids.max() < 1 << 16 else b"4" + squeeze.compress(b))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(b) // 4 for b in raw], pa.int64()), pa.array([zlib.crc32(b) for b in raw], pa.int64()),
                                              pa.array(packed, pa.binary())], ["doc_id", "n", "crc", "ids"])

    return documents(docs).mapInArrow(run, "doc_id long, n long, crc long, ids binary")


def unpack(packed: bytes, reader: zstandard.ZstdDecompressor) -> np.ndarray:
    return np.frombuffer(reader.decompress(packed[1:]), "<u" + packed[:1].decode()).astype("<u4", copy=False)


def count_ids(ids: DataFrame) -> dict[int, int]:
    """How often each id occurs in all documents; as many entries as the vocabulary at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, reader = np.zeros(1, np.int64), zstandard.ZstdDecompressor()
        for batch in slices(batches, "ids", 1 << 20):
            one = np.bincount(np.concatenate([unpack(b, reader) for b in batch.column("ids").to_pylist()]))
            if len(one) > len(total):
                one, total = total, one
            total[: len(one)] += one
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["symbol", "n"])

    rows = ids.select("ids").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    return {r.symbol: r.n for r in rows}


def write(ids: DataFrame, path: str) -> None:
    """Write the result of ``tokenize`` (kept on disk, as it is read three times) as a dataset folder.

    Documents go in ascending ``doc_id``, null first; those that share an id in
    the order of their ids' checksum and bytes. No document: empty tables.
    """
    spark = ids.sparkSession
    symbols, freq = frequencies(count_ids(ids))
    spark.createDataFrame(list(zip(symbols.tolist(), freq.tolist())), "symbol long, freq long").write.mode("overwrite").parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((symbols, freq))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, reader = Coder(*shared.value), TaskContext.get().partitionId(), zstandard.ZstdDecompressor()
        number = before = 0
        held: list[tuple[np.ndarray, list[dict]]] = []

        def flush() -> pa.RecordBatch:
            nonlocal held, number, before
            rows = []
            for (ids, pieces), payload in zip(held, coder.encode([ids for ids, _ in held])):
                rows.append({"part": part, "block": number, "before": before, "n_ids": len(ids), "ids_crc32": zlib.crc32(ids.tobytes()), "payload": payload, "pieces": pieces})
                number, before = number + 1, before + len(ids)
            held = []
            return pa.RecordBatch.from_pylist(rows, SCHEMA)

        docs = ((doc_id, unpack(packed, reader)) for batch in slices(batches, "ids", 1 << 20)
                for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()))
        for block in cut(docs):
            held.append(block)
            if len(held) == TOGETHER:
                yield flush()
        if held:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (ids.repartitionByRange(n, "doc_id", "crc").sortWithinPartitions("doc_id", "crc", "ids")
     .mapInArrow(run, BLOCKS).write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks"))


SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("payload", pa.binary()),
                    ("pieces", pa.list_(pa.struct([("doc_id", pa.int64()), ("seq", pa.int64()), ("piece", pa.int32()), ("n", pa.int64()), ("whole", pa.bool_())])))])


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a dataset folder, ids as little-endian u32; a damaged block raises."""
    rows = spark.read.parquet(f"{path}/table").collect()
    counts = {r.symbol: r.freq for r in rows}
    shared = spark.sparkContext.broadcast((np.array(sorted(counts), np.int64), np.array([counts[s] for s in sorted(counts)], np.int64)))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        for batch in slices(batches, "payload", 1 << 20):
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pylist(list(split(rows, coder.decode([r["payload"] for r in rows]))), PIECE)

    # As many rows as the writer had partitions, however large the data.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    long = F.exists("pieces", lambda x: ~x["whole"])  # a block with a piece of a longer document holds nothing else

    def pieces(some: DataFrame) -> DataFrame:
        found = some.mapInArrow(run, "part int, seq long, doc_id long, piece int, start long, n long, ids binary")
        return found.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("part_start"))

    joined = F.transform(F.array_sort(F.collect_list(F.struct("piece", F.hex("ids").alias("h")))), lambda x: x["h"])
    more = pieces(blocks.where(long)).groupBy("part", "seq", "doc_id").agg(F.min("start").alias("start"), F.sum("n").alias("n_tokens"), F.unhex(F.array_join(joined, "")).alias("ids"))
    return pieces(blocks.where(~long)).select("doc_id", "start", F.col("n").alias("n_tokens"), "ids").unionByName(more.drop("part", "seq"))


def cut(docs: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[tuple[np.ndarray, list[dict]]]:
    """Blocks of up to BLOCK ids with their documents' pieces: whole documents, or a part of one that is longer."""
    held, pieces, room = [], [], BLOCK
    for seq, (doc_id, ids) in enumerate(docs):
        if held and len(ids) > room:
            yield np.concatenate(held), pieces
            held, pieces, room = [], [], BLOCK
        if len(ids) > BLOCK:
            for i, at in enumerate(range(0, len(ids), BLOCK)):
                now = ids[at : at + BLOCK]
                yield now, [{"doc_id": doc_id, "seq": seq, "piece": i, "n": len(now), "whole": False}]
        else:
            held.append(ids)
            pieces.append({"doc_id": doc_id, "seq": seq, "piece": 0, "n": len(ids), "whole": True})
            room -= len(ids)
    if held:
        yield np.concatenate(held), pieces


PIECE = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])


def split(rows: list[dict], decoded: Iterable[np.ndarray]) -> Iterator[dict]:
    """The documents' pieces of decoded blocks; ``start`` counts from the start of the part."""
    for r, ids in zip(rows, decoded):
        if len(ids) != r["n_ids"] or zlib.crc32(ids.tobytes()) != r["ids_crc32"]:
            raise ValueError(f"block {r['block']} of part {r['part']} is damaged")
        at = 0
        for p in r["pieces"]:
            yield {"part": r["part"], "seq": p["seq"], "doc_id": p["doc_id"], "piece": p["piece"], "start": r["before"] + at, "n": p["n"], "ids": ids[at : at + p["n"]].tobytes()}
            at += p["n"]


def token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Tokenise all documents, write them to ``path`` and return what ``read`` finds there."""
    write(materialize(tokenize(docs, tokenizer, end_id), "ids"), path)
    return read(docs.sparkSession, path)
