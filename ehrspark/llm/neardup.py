"""MinHash near-duplicates with sequential Bayesian verification (operator 3).

A document's set holds its distinct shingles, each a 64-bit hash of five
words; documents with equal sets are one node from the start. Nodes whose
MinHash signatures agree in a band are candidates. Candidates' signatures are
compared batch by batch: given m equal of n hashes the similarity has the
posterior Beta(m + 1, n - m + 1), and a pair is dropped once the chance that
it reaches the threshold is below ``miss``. Survivors are verified exactly on
the full sets.

Only components are asked for, so pairs that links already join need no test.
Three rounds find the rest without listing all pairs of a bucket: each node
with the least node it shares a bucket with; each node with some drawn from
its buckets, again and again while that finds links;
then all pairs of nodes in one bucket that are still in different components,
tile by tile, where a tile holds some of a bucket's nodes.
Together they cover every candidate pair, whatever the size of a bucket.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize, noting
from .common import DROPS, claim, documents, slices
from .graph import counted_components, follow, light

HASHES, ROWS, BATCH = 128, 4, 32  # in a signature, a band, a batch
DRAWS, HEADS = 6, 4  # rounds with drawn heads, and heads for each node
SMALL, WHOLE = 8 << 20, 4 << 20  # bytes of sets, or of signatures, that are broadcast; that are so without a look for those in need
TILE, TILE_IDS, WIDE = 256, 1 << 18, 4096  # sets, and shingles, in a tile of the last round; shingles compared at once
IDS = 2 << 20  # ids that are broadcast, about 100 MB, to pick rows without a shuffle of them
#: Odd multipliers and offsets of the hash family, and the shingle's word places.
RNG = np.random.default_rng(20_240_601)
TIMES, PLUS = RNG.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1), RNG.integers(0, 1 << 32, HASHES, np.uint32)
PLACES = RNG.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
KNOWN: dict[bytes, int] = {}
DROPS["neardup"] = KNOWN.clear


@dataclass(frozen=True)
class Rule:
    words: int = 5
    part: int = 75  # link if 100 * common >= part * union
    miss: float = 1e-6


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; of fewer words, of the whole sequence."""
    tokens = text.encode().lower().split()  # of bytes: ASCII letters and white space only
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(KNOWN) > 300_000:
        KNOWN.clear()
    known = KNOWN.get
    h = np.array([known(t) or KNOWN.setdefault(t, xxhash.xxh64_intdigest(t)) for t in tokens], np.uint64)
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        out += h[k : k + len(out)] * PLACES[k % 64]
        out = (out ^ (out >> np.uint64(29))) * PLACES[(k + 7) % 64]
    return np.unique(out)


def signature(s: np.ndarray) -> bytes:
    low = ((s ^ (s >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 4096):
        best = np.minimum(best, (low[k : k + 4096, None] * TIMES + PLUS).min(0))
    return best.astype("<u4").tobytes()


def least_matches(rule: Rule) -> list[int]:
    """For n = BATCH, 2 BATCH, ...: the fewest equal hashes with which a pair goes on."""
    t = rule.part / 100
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        # P(S >= t) for Beta(m + 1, n - m + 1) is the chance of at most m of n + 1 trials at t.
        chance = np.cumsum([math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m) for m in range(n + 1)])
        out.append(int(np.argmax(chance >= rule.miss)))
    return out


def nodes(docs: DataFrame, rule: Rule, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_shingles, digest, signature, carry…) of each row; a null or blank text has the null digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("neardup")
        for batch in slices(batches, "text", 1 << 20):
            sets = [shingles(t, rule.words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                                              pa.array([signature(s) if len(s) else None for s in sets], pa.binary()), *[batch.column(c) for c in carry]], ["doc_id", "n_shingles", "digest", "signature", *carry])

    return documents(docs, *carry).mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary" + "".join(f", `{c}` string" for c in carry))


def sets_of(docs: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("neardup")
        for batch in slices(batches, "text", 1 << 20):
            sets = [shingles(t, rule.words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                                              pa.array([len(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], ["digest", "n", "shingles"])

    return docs.mapInArrow(run, "digest binary, n long, shingles binary")


def within(held: DataFrame, ids: DataFrame, column: str = "node") -> DataFrame:
    """Rows of ``held`` whose ``column`` is among ``ids``; a null counts as 0 here.

    Up to IDS ids are broadcast, so that the texts, sets or signatures beside the column stay where they are.
    """
    return counted_within(held, ids, column)[0]


def counted_within(held: DataFrame, ids: DataFrame, column: str = "node") -> tuple[DataFrame, int]:
    """``within`` and how many different ids there are."""
    of = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    ids, told = noting(ids.toDF("_id").select(of("_id").alias("_id")).distinct())
    ids, n = materialize(ids, "ids"), told()["n"]
    return held.join(F.broadcast(ids) if n <= IDS else ids, of(F.col(column)) == F.col("_id"), "left_semi"), n


def common(sets: DataFrame) -> DataFrame:
    """(node, n, m): the size of each set, and how many of its shingles are in another of these sets too.

    Two sets have at most the lesser m in common, which is exact where they
    differ in shingles that no other set has, as edited copies of a text do.
    """
    schema = pa.schema([("node", pa.int64()), ("h", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "shingles", 4 << 20):
            held = [np.frombuffer(b, "<i8") for b in batch.column("shingles").to_pylist()]
            nodes_ = np.repeat(batch.column("node").to_numpy(), [len(h) for h in held])
            yield pa.RecordBatch.from_arrays([pa.array(nodes_), pa.array(np.concatenate(held))], schema=schema)

    spread = sets.select("node", "shingles").mapInArrow(run, "node long, h long")
    lone = spread.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.max("node").alias("node")).where("k = 1").groupBy("node").agg(F.count(F.lit(1)).alias("lone"))
    return sets.select("node", "n").join(lone, "node", "left").select("node", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("m"))


def bytes_of(each: Column) -> dict[str, Column]:
    """The bytes of all rows and of the largest, with what a row has beside."""
    return {k: F.coalesce(f(each + 64), F.lit(0)) for k, f in (("size", F.sum), ("most", F.max))}


def met(pairs: DataFrame, held: DataFrame, bytes_each: Column, told: dict[str, int] | None = None) -> DataFrame:
    """``held`` for the nodes of ``pairs``, to be broadcast if its rows add up to SMALL at most: many pairs of few nodes need no shuffle of sets then.

    If all of ``held`` adds up to WHOLE at most, the nodes of ``pairs`` need not be looked for. ``told``: what ``bytes_of`` is
    for ``held``, if known. The driver builds what is broadcast and keeps it until its garbage is collected.
    """
    def sizes(rows: DataFrame) -> dict[str, int]:
        return rows.agg(*[c.alias(k) for k, c in bytes_of(bytes_each).items()]).first().asDict()

    told = told or sizes(held)
    if told["size"] <= WHOLE:
        return F.broadcast(held)
    some, n = counted_within(held, pairs.select("a").union(pairs.select("b")))
    return F.broadcast(some) if n * told["most"] <= SMALL or sizes(some)["size"] <= SMALL else some


def prune(pairs: DataFrame, known: DataFrame, rule: Rule, told: dict[str, int] | None = None) -> DataFrame:
    """Pairs (a, b) whose signatures leave them a chance, by the sequential test. ``told``: see ``met``."""
    known = met(pairs, known, F.lit(4 * HASHES), told)
    a, b = (known.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}")) for x in "ab")
    # Sets whose sizes differ too much can't be linked at all.
    fit = (100 * F.least("n_a", "n_b") >= rule.part * F.greatest("n_a", "n_b"))
    both = pairs.join(a, "a").join(b, "b").where(fit).select("a", "b", "s_a", "s_b")
    enough = least_matches(rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, HASHES) for c in ("s_a", "s_b"))
            alive, equal = np.arange(len(x)), np.zeros(len(x), int)
            for least, k in zip(enough, range(0, HASHES, BATCH)):
                equal[alive] += (x[alive, k : k + BATCH] == y[alive, k : k + BATCH]).sum(1)
                alive = alive[equal[alive] >= least]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("a", "b")], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, rule: Rule, told: dict[str, int] | None = None) -> DataFrame:
    """Pairs (a, b) that are linked by their full sets. ``told``: see ``met``."""
    sets = met(pairs, sets, 8 * F.col("n"), told)
    a, b = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s_{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("s_a"), batch.column("s_b")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                linked.append(100 * common >= rule.part * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(linked, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    return pairs.join(a, "a").join(b, "b").select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def dealt(apart: DataFrame, sets: DataFrame, rule: Rule, tile: int = TILE, ids: int = TILE_IDS) -> DataFrame:
    """(bucket, i, j, side, node, comp, own, n) of the members of ``apart`` that may have a link, dealt to tiles of some
    ``tile`` members or ``ids`` shingles. Each tile meets each of its bucket, so a member comes once for each tile.

    Left out are sets with too many shingles of their own to meet any, and buckets whose others are of one component.
    """
    sized = apart.join(common(within(sets, apart.select("node"))).where(100 * F.col("m") >= rule.part * F.col("n")), "node")
    sized = materialize(sized.select("bucket", "node", "comp", "own", "n"), "sized")
    counts = sized.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max("own").alias("any"), F.greatest(
        F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n") / ids)).cast("int").alias("tiles")).where("x <> y and any").select("bucket", "tiles")
    rows = sized.join(counts, "bucket").withColumn("at", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.select("bucket", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), (F.col("at") > F.col("other")).alias("side"), "node", "comp", "own", "n")


def between(apart: DataFrame, sets: DataFrame, rule: Rule, tile: int = TILE, ids: int = TILE_IDS) -> DataFrame:
    """(a, b): links that join all components of ``apart`` (bucket, node, comp, own) that members of one bucket link,
    at least one of the two in its ``own``.

    All pairs of two tiles are compared at once, as a product of the matrices that tell which shingles a set has. Of
    the links found there go on those that join components, fewer than these.
    """
    rows = dealt(apart, sets, rule, tile, ids)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        node, comp, n = (t[c].to_numpy() for c in ("node", "comp", "n"))
        own, side = (t[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("own", "side"))
        one = key[1].as_py() == key[2].as_py()
        x, y = (np.arange(len(n)),) * 2 if one else (np.flatnonzero(~side), np.flatnonzero(side))
        may = (comp[x, None] != comp[y]) & (own[x, None] | own[y])
        if not may.any():
            return
        held = [np.frombuffer(b, "<u8") for b in t["shingles"].to_pylist()]
        row = np.repeat(np.arange(len(n)), [len(h) for h in held])
        _, column, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        row, column = row[times[column] > 1], (np.cumsum(times > 1) - 1)[column[times[column] > 1]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros(may.shape, np.int64)
        for at in range(0, int((times > 1).sum()), WIDE):
            a, b = np.searchsorted(column, [at, at + WIDE])
            has = np.zeros((len(n), WIDE), np.float32)
            has[row[a:b], column[a:b] - at] = 1
            both += (has[x] @ has[y].T).astype(np.int64)
        i, j = np.nonzero(may & (100 * both >= rule.part * (n[x, None] + n[y] - both)))
        # One link for each two components, and of these those that join what is not joined yet.
        pairs = np.stack([np.minimum(comp[x[i]], comp[y[j]]), np.maximum(comp[x[i]], comp[y[j]])])
        top: dict[int, int] = {}

        def root(c: int) -> int:
            while c in top:
                c = top[c]
            return c

        found = []
        for k in np.unique(pairs, axis=1, return_index=True)[1].tolist() if len(i) else []:
            u, v = root(int(pairs[0, k])), root(int(pairs[1, k]))
            if u != v:
                top[v] = u
                found.append(sorted((int(node[x[i[k]]]), int(node[y[j[k]]]))))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    return rows.join(sets.select("node", "shingles"), "node").groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    ``carry``: names of string columns of ``docs`` that come along, to tell rows of one id apart; then also ``component``,
    a number of the row's component, as several may have one least doc_id (null for an empty set, which is alone).

    component_id is the least doc_id that links lead to. A text that is null or
    has no word has an empty set and no links. Rows that share an id are linked
    by their texts like any others; a null id is less than all.
    """
    docs = documents(docs, *carry)
    rows = materialize(nodes(docs, rule, carry), "rows")
    known = rows.where("digest is not null").dropDuplicates(["digest"]).select("digest", "n_shingles", "signature", F.col("doc_id").alias("witness"))
    known = materialize(known.withColumn("node", F.monotonically_increasing_id()), "nodes")

    bands = F.transform(F.sequence(F.lit(0), F.lit(HASHES // ROWS - 1)), lambda i: F.xxhash64(i, F.substring("signature", 4 * ROWS * i + 1, 4 * ROWS)))
    members = known.select("node", F.explode(bands).alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(members.join(shared, "bucket").select("bucket", "node", "least"), "members")

    # Only nodes that share a bucket are looked at again; the sets are made from their texts.
    known_digests = known.select("digest", F.col("node").alias("comp"))
    noted, known_told = noting(within(known, members.select("node")), **bytes_of(F.lit(4 * HASHES)))
    known = materialize(noted, "met")
    found = sets_of(within(docs, known.select("witness"), "doc_id").select("text"), rule).dropDuplicates(["digest"])
    noted, sets_told = noting(found.join(known.select("digest", "node"), "digest").select("node", "n", "shingles"), **bytes_of(8 * F.col("n")))
    sets = materialize(noted, "sets")

    def counted(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
        noted, told = noting(rows)
        return materialize(noted, name), told()["n"]

    def links(pairs: DataFrame) -> tuple[DataFrame, int]:
        left, n = counted(prune(pairs, known, rule, known_told()), "survivors")
        return counted(verify(left, sets, rule, sets_told()), "found") if n else (left, 0)

    # Round 1: a node and the least node of all its buckets.
    tested, n_tested = counted(members.where("node <> least").groupBy("node").agg(F.min("least").alias("a")).select("a", F.col("node").alias("b")), "tested")
    roots, n_roots = counted_components(links(tested)[0])

    def mixed() -> tuple[DataFrame, int]:
        """Members of buckets that hold several components still; such a bucket is parted by the sizes of sets,
        where sets that can be linked share a part, their ``own`` or that of one of them. And how many they are."""
        parts = F.explode(F.array(F.col("step"), F.col("step") + 1))
        apart = follow(stepped.withColumn("comp", F.col("node")), "comp", light(roots, n_roots)).withColumn("part", parts)
        apart = apart.select(F.xxhash64("bucket", "part").alias("bucket"), "node", "comp", (F.col("part") == F.col("step")).alias("own"))
        some = apart.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bucket")
        return counted(apart.join(some, "bucket"), "apart")

    def test(pairs: DataFrame) -> bool:
        """Verify those pairs that weren't yet; whether any is linked."""
        nonlocal tested, n_tested
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(light(tested, n_tested), ["a", "b"], "left_anti")
        pairs, n = counted(pairs, "pairs")
        tested, n_tested = tested.unionByName(pairs), n_tested + n
        return n > 0 and join_up(*links(pairs))

    def join_up(more: DataFrame, n: int) -> bool:
        """The components that ``n`` links (a, b) join are one from now on; whether there are any."""
        nonlocal roots, n_roots
        if not n:
            return False
        known_roots = light(roots, n_roots)
        joined, n_joined = counted_components(follow(follow(more, "a", known_roots), "b", known_roots))
        roots = materialize(follow(roots, "root", light(joined, n_joined)).unionByName(joined), "roots")
        n_roots += n_joined
        return True

    step = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100 / rule.part))).alias("step")
    stepped = materialize(members.select("bucket", "node").join(known.select("node", step), "node"), "stepped")
    # Round 2, again and again while it helps: in each bucket a head is drawn, the same one in many buckets, and
    # each node is tested with the heads of other components that it meets most often.
    for draw in range(1, DRAWS + 1):
        apart, n = mixed()
        if not n:
            break
        drawn = F.xxhash64("node", F.lit(draw))
        heads = apart.groupBy("bucket").agg(F.min_by("node", drawn).alias("head"), F.min_by("comp", drawn).alias("head_comp"))
        often = apart.join(heads, "bucket").where("comp <> head_comp").groupBy("node", "head").agg(F.count(F.lit(1)).alias("n"))
        best = Window.partitionBy("node").orderBy(F.desc("n"), "head")
        often = often.withColumn("k", F.row_number().over(best)).where(F.col("k") <= HEADS)
        if not test(often.select(F.col("head").alias("a"), F.col("node").alias("b"))):
            break
    else:
        apart, _ = mixed()
    # Round 3: what is left.
    join_up(*counted(between(apart, sets, rule), "rest"))

    # From nodes back to documents: the least id of a component's rows.
    classes = follow(known_digests, "comp", light(roots, n_roots))
    placed = rows.select("doc_id", "n_shingles", "digest", *carry).join(classes, "digest", "left")
    least = placed.where("comp is not null").groupBy("comp").agg(F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("_least"))
    out = placed.join(least, "comp", "left")
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.expr("nullif(_least, -9223372036854775807 - 1)"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), *[F.col(c) for c in carry], *([F.col("comp").alias("component")] if carry else []))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
