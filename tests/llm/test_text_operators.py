"""Operators on texts against brute force, on edge cases and on a driver table."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edge_rows import EDGE
from ehrspark.llm import graph, hmm, imatch, langid, licenses, mixing, neardup, packing, rans, tokens, toxicity
from ehrspark.llm.common import bucket_of, table
from ehrspark.session import scratch_path



SF_SMALL = "/root/testdata/sf0.001"


def byte_words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_SMALL, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").orderBy("doc_id").collect()]


@pytest.mark.parametrize("kind,name", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_chunks_encode_as_the_whole_text(rows, kind, name):
    enc = tokens.ChunkEncoder(public_tokenizers.path(name), kind, keep=500)
    rng = np.random.default_rng(3)
    odd = ["".join(rng.choice(list("ab Cé \n\t.,'s1　\xa0\x85\x1cß́²İΣK"), rng.integers(0, 16))) for _ in range(3000)]
    texts = odd + [r[1] for r in rows[:60]]
    for part in range(0, len(texts), 500):
        some = texts[part : part + 500]
        got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode(some)]
        assert got == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in some]


@pytest.mark.parametrize("kind,name", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_added_tokens_encode_as_the_library_does(kind, name):
    path = public_tokenizers.path(name)
    texts = ["hello <|endoftext|> world", "plain words, here", "<|endoftext|>", "a<|ENDOFTEXT|>b  <|startoftext|>\nC é", "<|endoftext", "", "x <|endoftext|><|endoftext|> y"]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in tokens.ChunkEncoder(path, kind).encode(texts)] == want
    assert (49407 if kind == "word" else 50256) in want[0]


@pytest.mark.parametrize("kind,name", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_long_texts_are_cut_where_no_chunk_breaks(kind, name, monkeypatch):
    monkeypatch.setattr(tokens, "PART", 40)
    enc = tokens.ChunkEncoder(public_tokenizers.path(name), kind)
    texts = ["A longer text, with  two spaces and\nlines. " * 20, "x" * 300, " " * 100 + "a b", "word " * 50, "", "é, è. " * 40]
    assert max(len(tokens.parts(t)) for t in texts) > 5
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


class Counted:
    """A tokenizer that counts the chunks it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, Counter()

    def encode_batch_fast(self, texts, **more):
        for t in texts:
            self.seen.update(t.split())
        return self.tokenizer.encode_batch_fast(texts, **more)


@pytest.mark.parametrize("kind,name", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_frequent_chunks_stay_in_memory(kind, name):
    enc = tokens.ChunkEncoder(public_tokenizers.path(name), kind, keep=400)
    letters = lambda n, k: "".join(chr(97 + n // 26**i % 26) for i in range(k))
    often = [letters(k, 3) for k in range(100)]
    rare = iter(letters(k, 5) for k in range(10**6))
    enc.encode([" ".join(["x", *(next(rare) for _ in range(400))])])
    enc.tokenizer = enc.words = seen = Counted(enc.words)
    for _ in range(12):
        enc.encode([" ".join(["x", *often * 3, *(next(rare) for _ in range(200)), "z" * 60])])
    assert max(seen.seen[w] for w in often) <= 1
    assert len(enc.names) <= 400 and len(enc.ids) == enc.sizes.sum()


@pytest.mark.parametrize("kind,name", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_texts_cut_in_groups_encode_as_alone(kind, name, monkeypatch):
    monkeypatch.setattr(tokens, "PART", 40)
    enc = tokens.ChunkEncoder(public_tokenizers.path(name), kind)
    texts = ["", " thnthahe&&& ERNDNDST!!", "Rentwhti$$$ it's,", "", "  don't 555-0362 \u2003é&%", "\n x\x1c y", "", "w " * 70, ""]
    assert len(list(tokens.groups(texts))) > 2
    for some in (texts, texts[::-1], [], [""], texts):
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(some)] == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def brute_licenses(text, known, gap, share):
    """Labels, spans and score of one text by going through all templates."""
    words = [w for w in __import__("re").split(licenses.NO_WORD, text.translate(str.maketrans(licenses.UPPER, licenses.LOWER))) if w]
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    spans, best = [], 0.0
    for label, places in known:
        diagonals = {}
        for place, pair in enumerate(pairs):
            for at, p in places:
                if p == pair:
                    diagonals.setdefault(place - at, []).append((place, pair))
        groups, last = [], None
        for d in sorted(diagonals, key=lambda d: (d, min(diagonals[d])[0])):
            low, high = min(diagonals[d])[0], max(diagonals[d])[0]
            if last and d - last[0] <= gap and low - last[1] <= gap:
                groups[-1] += diagonals[d]
            else:
                groups.append(list(diagonals[d]))
            last = d, high
        for g in groups:
            score = len({p for _, p in g}) / len({p for _, p in places})
            best = max(best, score)
            if score >= share:
                spans.append((min(g)[0], max(g)[0] + 1, label, score))
    return sorted({s[2] for s in spans}), sorted(spans), best


def test_license_labels_and_scores_equal_brute_force(spark, frame):
    rng = np.random.default_rng(12)
    vocabulary = [f"w{i}" for i in range(12)]
    draw = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    texts = {tuple(draw(int(rng.integers(9, 16)))): f"t{k}" for k in range(6)}
    notices = {"n": [" ".join(draw(5))], "m": [" ".join(draw(7))]}
    docs = []
    for i in range(60):
        words = draw(int(rng.integers(0, 30)))
        for part in [list(list(texts)[i % 6])] + [x[0].split() for x in notices.values()]:
            part = part[:]
            if rng.random() < 0.5:
                part.insert(int(rng.integers(0, len(part))), "new")
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = part
        docs.append((i, " ".join(words), None, None))
    docs += [(100, "", None, None), (101, None, None, None)]
    for common, short in ((None, 8), (2, 3)):
        counts = Counter(p for words in texts for p in set(zip(words, words[1:])))
        known = [(label, [(i, f"{a} {b}") for i, (a, b) in enumerate(zip(t.split(), t.split()[1:]))]) for label, ts in notices.items() for t in ts]
        for words, label in texts.items():
            places = [(i, f"{a} {b}") for i, (a, b) in enumerate(zip(words, words[1:]))]
            rare = [(i, p) for i, p in places if common is None or counts[tuple(p.split())] <= common]
            known.append((label, rare if len({p for _, p in rare}) >= short else places))
        got = licenses.scan(frame(docs), {}, notices, texts=texts, common=common, short=short).collect()
        assert len(got) == len(docs)
        for r in got:
            labels, spans, score = brute_licenses(dict((d[0], d[1]) for d in docs)[r.doc_id] or "", known, 4, 0.8)
            assert r.labels == ",".join(labels) and r.score == pytest.approx(score), r
            assert [(s["first"], s["last"], s["label"]) for s in r.spans] == [s[:3] for s in spans]


def test_common_pairs_vote_where_a_license_is_possible(frame):
    """Labels and spans are those of all pairs, whatever few pairs vote first; common ones were left out before."""
    rng = np.random.default_rng(21)
    draw = lambda n: [f"w{i}" for i in rng.integers(0, 14, n)]
    shared = draw(12)
    texts = {tuple(shared[: 4 + k] + draw(10) + shared[k:]): f"t{k}" for k in range(8)}
    docs = [(i, " ".join(w for w in draw(5) + list(list(texts)[i % 8]) + draw(5) if rng.random() > 0.04 * (i % 4)), None, None) for i in range(64)]
    scan = lambda **how: {r.doc_id: (r.labels, [tuple(s) for s in r.spans]) for r in licenses.scan(frame(docs), {}, {"n": ["w1 w2 w3"]}, texts=texts, **how).collect()}
    want = scan(rare=1000)
    known = [("n", [(0, "w1 w2"), (1, "w2 w3")])] + [(label, [(i, f"{a} {b}") for i, (a, b) in enumerate(zip(w, w[1:]))]) for w, label in texts.items()]
    assert {i: got[0] for i, got in want.items()} == {i: ",".join(brute_licenses(t, known, 4, 0.8)[0]) for i, t, *_ in docs}
    assert 8 < sum(bool(x) for x, _ in want.values()) < 64
    for rare in (1, 2, 5):
        assert scan(rare=rare) == want
    assert scan(common=2, short=3) != want


def test_rans_blocks_round_trip():
    rng = np.random.default_rng(0)
    blocks = [(rng.zipf(1.4, n) % 50_000).astype("<u4") for n in (1, 5, 31, 32, 33, 4096, 4097, 16_384)]
    coder = rans.Coder(*rans.frequencies(Counter(np.concatenate(blocks).tolist())))
    coded = coder.encode(blocks)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, coder.decode(coded)))
    assert all((a == b).all() for a, b in zip(blocks[::-1], coder.decode(coded[::-1])))
    bad = bytearray(coded[-1])
    bad[200] ^= 1
    with pytest.raises(ValueError):
        coder.decode([bytes(bad)])


def test_rans_file_holds_all_ids(spark, frame, docs, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    for k, (df, source) in enumerate(((frame(EDGE), EDGE), (docs, rows), (frame(EDGE).limit(0), []))):
        out = rans.token_file(df, scratch_path(spark, f"rans-test-{k}"), path).orderBy("start").collect()
        want, start = [], 0
        for i, t, *_ in sorted(source, key=lambda r: (r[0] is not None, r[0] or 0)):
            ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
            want.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
            start += len(ids)
        assert [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in out] == want


def test_packing_places_every_piece_once(frame, docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    for df, source in ((frame(EDGE), EDGE), (docs, rows)):
        packed = packing.pack(df, path, size=512, keep_ids=True).cache()
        got = packed.toPandas()
        want = Counter()
        for i, t, *_ in source:
            ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
            first = len(ids) % 512 or 512
            for p, a in enumerate([0, *range(first, len(ids), 512)]):
                b = first if p == 0 else a + 512
                want[(i, p, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
        own = got.doc_id.astype(object).where(got.doc_id.notna(), None)
        assert Counter(zip([None if x is None else int(x) for x in own], got.piece, got.start, got.length, got.ids_crc32)) == want
        for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
            assert g.offset.tolist() == np.cumsum([0, *g.length[:-1]]).tolist() and g.length.sum() <= 512
        assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 512) + 1
        assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == 4 * got.length.sum()
        packed.unpersist()
    assert packing.pack(frame(EDGE).limit(0), path).count() == 0


def test_hmm_base_and_chain(frame, docs, rows):
    for df, source in ((frame(EDGE), EDGE), (docs, rows)):
        got = hmm.score(df, bucket_of(F.col("doc_id")) == 1).toPandas()
        held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, *_ in source}
        seen = Counter()
        for i, t, *_ in source:
            if not held[i]:
                seen.update(byte_words(t))
                seen[b""] += 1
        n, v = sum(seen.values()), len(seen)
        want = {}
        for i, t, *_ in source:
            w = byte_words(t) + [b""]
            want.setdefault(i, []).append((held[i], len(w), sum(x in seen for x in w), n, sum(np.log10((seen[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
        assert len(got) == len(source)
        for r in got.itertuples():
            i = None if np.isnan(r.doc_id) else int(r.doc_id)
            assert any((r.held_out, r.n_tokens, r.n_known, r.train_tokens) == x[:4] and abs(r.base_score - x[4]) <= 1e-8 * max(1, abs(x[4])) for x in want[i])
    assert got[got.held_out].score.sum() > got[got.held_out].base_score.sum()
    assert hmm.score(frame(EDGE).limit(0), F.lit(False)).count() == 0
    assert hmm.score(frame(EDGE), F.lit(True)).where("train_tokens = 0 and n_known = 0").count() == len(EDGE)


def test_forward_recursion_equals_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    s, c = hmm.STATES, hmm.CLASSES
    emit = rng.random((c, s))
    move = rng.random((s, s))
    model = hmm.Model(np.full(s, 1 / s), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    seqs = [np.array(x) for x in ([5], [1, 2, 3, 0], [7] * 9, [0])]
    for q, got in zip(seqs, hmm.log_likelihood(model, seqs)):
        a = model.first * model.emit[q[0]]
        for k in q[1:]:
            a = (a @ model.move) * model.emit[k]
        assert abs(got - np.log(a.sum())) < 1e-9
    counts = hmm.expected(model, seqs, np.ones(len(seqs), bool))
    assert abs(counts[: c * s].sum() - sum(map(len, seqs))) < 1e-3 and abs(counts[-1] - hmm.log_likelihood(model, seqs).sum()) < 1e-3


def test_near_duplicates_equal_brute_force(frame, docs, rows):
    text = "one two three four five six seven eight nine ten " * 1
    near = [(20 + k, text + " ".join(f"w{j}" for j in range(60) if j != k), "en", "a") for k in range(6)]
    few = [(40, "a b", "en", "a"), (41, "A  b", "en", "a"), (42, "a b c", "en", "a")]
    for df, source in ((frame(EDGE + near + few), EDGE + near + few), (docs, rows)):
        sets = []
        for i, t, *_ in source:
            w = byte_words(t)
            sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
        least = {k: (i is not None, i or 0) for k, (i, _) in enumerate(sets)}
        root = list(range(len(sets)))

        def find(a):
            while root[a] != a:
                a = root[a]
            return a

        for a in range(len(sets)):
            for b in range(a):
                x, y = sets[a][1], sets[b][1]
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    p, q = find(a), find(b)
                    root[max(p, q, key=least.get)] = min(p, q, key=least.get)
        want = Counter((i, len(s), sets[find(k)][0], i == sets[find(k)][0]) for k, (i, s) in enumerate(sets))
        got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect())
        assert got == want
    assert neardup.near_duplicates(frame(EDGE).limit(0)).count() == 0


def test_last_round_meets_tiles_not_pairs(spark):
    """Links that join components equal brute force for small tiles, and members come once for each tile of a bucket."""
    rng, rule = np.random.default_rng(5), neardup.Rule()
    base = rng.integers(0, 1 << 62, 60)
    sets = [np.unique(np.concatenate([rng.choice(base, int(rng.integers(43, 53)), replace=False), base[:2] + 1 + k % 7])) for k in range(90)]
    comp = [k // 3 if k < 30 else k for k in range(90)]
    own = [k % 4 != 0 for k in range(90)]
    held = spark.createDataFrame([(k, len(s), bytearray(s.astype("<u8").tobytes())) for k, s in enumerate(sets)], "node long, n long, shingles binary")
    members = [(b, k, comp[k], own[k]) for k in range(90) for b in {k % 2, 2 + k % 5}]
    apart = spark.createDataFrame(members, "bucket long, node long, comp long, own boolean")

    def classes(links):
        root = {c: {c} for c in comp}
        for a, b in links:
            root |= dict.fromkeys(both := root[comp[a]] | root[comp[b]], both)
        return {frozenset(x) for x in root.values()}

    of = {}
    for b, k, *_ in members:
        of.setdefault(b, []).append(k)
    want = {(a, b) for some in of.values() for a in some for b in some if a < b and comp[a] != comp[b] and (own[a] or own[b])
            and 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    assert 0 < len(want) and 1 < len(classes(want)) < len(set(comp))
    for tile, ids in ((256, 1 << 18), (4, 1 << 18), (256, 200)):
        got = {(r.a, r.b) for r in neardup.between(apart, held, rule, tile, ids).collect()}
        assert got <= want and classes(got) == classes(want)
    many = spark.createDataFrame([(0, k, k, True) for k in range(90)], "bucket long, node long, comp long, own boolean")
    assert neardup.dealt(many, held, rule, 30).count() == 90 * 3
    assert neardup.dealt(many, held, rule, 90).count() == 90


def test_few_nodes_are_not_shuffled(spark, monkeypatch):
    """Small tables of sets, signatures and roots are broadcast as they are, and larger ones lead to the same rows."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:20] if i < 9 else rng.permutation(base)[:30].tolist()) + f" end{i % 3}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made, write = [], neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda rows, name: (made.append(name), write(rows, name))[1])

    def result():
        made.clear()
        return sorted(map(tuple, neardup.near_duplicates(df).collect()))

    few = result()
    assert made.count("ids") == 3 and made.count("found") >= 1  # for the nodes that share a bucket, their texts and the last round
    monkeypatch.setattr(neardup, "SMALL", 0)
    monkeypatch.setattr(neardup, "WHOLE", 0)
    monkeypatch.setattr(graph, "FEW", 0)
    assert result() == few and made.count("ids") > 4
    roots = write(spark.createDataFrame([(5, 1)], "node long, root long"), "test-roots")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, join in ((0, "SortMergeJoin"), (1, "BroadcastHashJoin")):
            monkeypatch.setattr(graph, "FEW", most)
            out = graph.follow(spark.range(7), "id", graph.light(roots))
            assert join in out._jdf.queryExecution().executedPlan().toString()
            assert sorted(r.id for r in out.collect()) == [0, 1, 1, 2, 3, 4, 6]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_written_tables_are_not_counted_by_jobs_of_their_own(spark, monkeypatch):
    """How many rows a table has, and whether any, is noted as it is written."""
    def no(self, *args):
        raise AssertionError("a job of its own")

    texts = ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g", "x y z", "x y z", "u v w x y z", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with monkeypatch.context() as m:
        for name in ("count", "isEmpty", "collect", "head", "first"):
            m.setattr(type(df), name, no)
        out = neardup.near_duplicates(df, neardup.Rule(part=50))
        empty = neardup.near_duplicates(df.where("doc_id < 0"))
    assert {r.doc_id: r.component_id for r in out.collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7}
    assert empty.count() == 0


def test_driver_broadcasts_few_sets_only(spark):
    """Sets of 10 MB are not broadcast, two of them are, whether their sizes are known or not."""
    held = spark.range(10).select(F.col("id").alias("node"), F.lit(1 << 17).cast("long").alias("n"))
    told = {"size": 10 * ((1 << 20) + 64), "most": (1 << 20) + 64}
    every = spark.range(9).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    for pairs, broadcast, n in ((every, False, 10), (every.limit(1), True, 2)):
        for known in (told, None):
            out = neardup.met(pairs, held, 8 * F.col("n"), known)
            assert ("strategy=broadcast" in out._jdf.queryExecution().analyzed().toString().split("LeftSemi")[0]) == broadcast and out.count() == n


def test_components_of_chains(spark, monkeypatch):
    """Roots of long chains, broadcast or shuffled."""
    links = [(a, a + 1) for a in range(0, 40, 2)] + [(a, a + 1) for a in range(1, 39, 2) if a % 8 != 7] + [(99, 50), (50, 77), (60, 60)]
    for few in (1 << 16, 3):
        monkeypatch.setattr(graph, "FEW", few)
        got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == {k: k - k % 8 for k in range(40) if k % 8} | {99: 50, 77: 50}


def test_later_rounds_join_what_the_first_left(spark):
    """A chain of texts in which neighbours are linked and others aren't."""
    words = [f"w{k}" for k in range(400)]
    chain = [(k, " ".join(words[6 * k : 6 * k + 60]), "en", "a") for k in range(40)]
    got = neardup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string, lang string, source string")).collect()
    assert {r.component_id for r in got} == {0}


def test_imatch_edited_texts_and_equal_fingerprints(frame, docs, rows):
    import hashlib

    for df, source in ((frame(EDGE), EDGE), (docs, rows)):
        got = imatch.fingerprints(df).collect()
        order = sorted(source, key=lambda r: (r[0] is not None, r[0] or 0))
        texts = [t or "" for _, t, *_ in order]
        want = Counter()
        for k, t in enumerate(texts):
            h, nxt = len(t) // 2, texts[(k + 1) % len(texts)]
            want[(order[k][0], len(t), hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest())] += 1
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_id = {i: t for i, t, *_ in rows}
    prints = {}
    for r in got:
        assert prints.setdefault(by_id[r.doc_id], r.fingerprint) == r.fingerprint
    assert sum(r.near_edited for r in got) > 5 * sum(r.near_next for r in got)
    assert imatch.fingerprints(frame(EDGE).limit(0)).count() == 0


def test_imatch_buckets_split_an_id_of_many_rows_in_order(spark):
    rows = [(None, f"null {i}") for i in range(400)] + [(i, f"text {i}") for i in range(100)] + [(50, f"again {i}") for i in range(300)]
    got = imatch.ordered_buckets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 16).collect()
    assert len(got) == len(rows)
    assert [r.bucket for r in sorted(got, key=lambda r: (r.ord, r.t, r.text))] == sorted(r.bucket for r in got)
    assert len({r.bucket for r in got if r.doc_id is None}) > 4 and len({r.bucket for r in got if r.doc_id == 50}) > 3
    assert max(Counter(r.bucket for r in got).values()) < 120


def test_licenses_equal_brute_force(frame, docs, rows):
    more = [(30, "MIT license mit License, general public\nlicense", None, None), (31, "Licensed under the extra Apache License, Version 2.0.", None, None), (32, "Licensed under CC BY-NC 4.0.", None, None)]
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    for df, source in ((frame(EDGE + more), EDGE + more), (docs, rows)):
        want = Counter()
        for i, t, *_ in source:
            w = licenses.split(t or "")
            hits = [(k, label) for k in range(len(w)) for p, label in phrases.items() if tuple(w[k : k + len(p)]) == p]
            places = [k for k, _ in hits]
            want[(i, len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits})))] += 1
        got = licenses.scan(df).collect()
        assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
        assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    edge = {r.doc_id: r.labels for r in licenses.scan(frame(more)).collect()}
    assert edge == {30: "gpl,mit", 31: "apache,apache-2.0", 32: "cc-by-nc"}
    assert licenses.scan(frame(EDGE).limit(0)).count() == 0


def fill(sizes, share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        rest = total - sum(2 * sizes[s] for s in full)
        out = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in open_) for s in names}
        over = {s for s in open_ if out[s] > 2 * sizes[s]}
        if not over:
            return out
        full |= over


def test_mixing_targets_and_takings(frame, docs, rows):
    for df, source in ((frame(EDGE), EDGE), (docs, rows)):
        sizes, by_source = {}, {}
        for i, t, _, s in source:
            by_source[s] = by_source.get(s, 0) + len((t or "").encode().split())
        goal = fill(by_source)
        takings = mixing.mix(df)
        got = takings.collect()
        assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got) == Counter((i, len((t or "").encode().split()), by_source[s], round(goal[s], 6)) for i, t, _, s in source)
        assert all(0 <= r.taken <= 2 * r["size"] for r in got)
        again = {(r.doc_id, r["size"], r.taken) for r in mixing.mix(df.repartition(3)).collect()}
        assert again == {(r.doc_id, r["size"], r.taken) for r in got}
        taken = {}
        for r in got:
            taken[round(r.target, 6)] = taken.get(round(r.target, 6), 0) + r.taken
        wanted = {}
        for s, g in goal.items():
            wanted[round(g, 6)] = wanted.get(round(g, 6), 0) + g
        assert all(abs(taken[k] - w) <= max(130, 0.05 * w) for k, w in wanted.items())
        mixed = mixing.mixed(df, takings)
        assert mixed.columns == df.columns
        assert sum(len((r.text or "").encode().split()) for r in mixed.select("text").collect()) == sum(r.taken for r in got)
    assert mixing.mix(frame(EDGE).limit(0)).count() == 0


def test_language_held_out(frame, docs):
    model = langid.fit(docs, bucket_of(F.col("doc_id")) != 0)
    got = langid.predict(docs.select("doc_id", "text", "lang"), model).where(bucket_of(F.col("doc_id")) == 0).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.9 and got.score.between(0, 1).all()
    edge = langid.predict(frame(EDGE).select("doc_id", "text"), model).collect()
    assert len(edge) == len(EDGE)
    assert {r.doc_id for r in edge if r.lang_pred == "und"} == {1, 2, 5, 7}
    none = langid.predict(frame(EDGE).select("doc_id", "text"), langid.fit(frame(EDGE).limit(0), F.lit(True))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    long = langid.fit(docs, F.lit(True))
    cut = " ".join(["la table est grande"] * 60_000)
    assert langid.predict(frame([(1, cut, None, None)]).select("text"), long).first().score > 0.5


def test_toxicity_finds_the_sentence(spark, frame):
    rng = np.random.default_rng(5)
    plain = [f"w{k}" for k in range(300)]

    def text(toxic):
        sentences = [" ".join(rng.choice(plain, 8)) + "." for _ in range(rng.integers(1, 12))]
        if toxic:
            sentences.insert(rng.integers(0, len(sentences) + 1), "you " + rng.choice(["vilex", "vilexo", "grumpf"]) + " thing!")
        return " ".join(sentences)

    made = [(k, text(k % 4 == 0), int(k % 4 == 0)) for k in range(800)]
    df = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, F.col("doc_id") < 600)
    got = toxicity.score(df.where("doc_id >= 600"), model, spans=True).collect()
    assert sum((r.predicted == 1) == (r.toxic == 1) for r in got) >= 0.97 * len(got)
    for r in got:
        for o in r.offending:
            assert any(x in r.text[o.start : o.end] for x in ("vilex", "grumpf")) or r.toxic == 0
    edge = toxicity.score(frame(EDGE).select("doc_id", "text"), model).collect()
    assert len(edge) == len(EDGE) and all(0 <= r.score <= 1 for r in edge)
    nothing = toxicity.fit(df.limit(0), F.lit(True))
    assert {round(r.score, 3) for r in toxicity.score(df.limit(3).select("text").limit(0), nothing).collect()} == set()


def test_toxicity_of_a_long_clean_text(spark):
    """Of 20,000 sentences none alone is telling, one in a hundred has a word that toxic texts prefer."""
    rng = np.random.default_rng(6)
    plain = [f"w{k}" for k in range(300)]

    def text(toxic, n):
        some = [" ".join(rng.choice(plain, 8)) + (" mild." if rng.random() < 0.01 else ".") for _ in range(n)]
        if toxic:
            some.insert(rng.integers(0, n + 1), rng.choice(["you vilex mild thing!", "you grumpf thing!"]))
        return " ".join(some)

    made = [(k, text(k % 4 == 0, rng.integers(1, 12)), int(k % 4 == 0)) for k in range(800)]
    model = toxicity.fit(spark.createDataFrame(made, "doc_id long, text string, toxic int"), F.lit(True))
    neutral = " ".join("w1 w2 w3." for _ in range(20_000))
    long = [(0, neutral), (1, text(0, 20_000)), (2, neutral + " you grumpf thing! " + neutral)]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(long, "doc_id long, text string"), model).collect()}
    assert got[0].score == 0 and got[0].n_sentences == 20_000
    assert got[1].predicted == 0 and got[1].score < 0.5
    assert got[2].predicted == 1 and got[2].worst == 20_000


def test_licenses_by_their_bodies(frame):
    """Paragraphs without the opening sentence or notice, wrapped as comments, and prose that is no license."""
    mit = "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    apache = "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."
    bsd = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    unlicense = "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    gpl = "You may convey verbatim copies of the Program's source code as you receive it, in any medium, provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice; keep intact all notices stating that this License and any non-permissive terms added in accord with section 7 apply to the code; keep intact all notices of the absence of any warranty; and give all recipients a copy of this License along with the Program."
    prose = "You may use the software of the library for any purpose, and the terms of the contract apply to the work in the form of a copy of the text."
    texts = [mit, apache, bsd, isc, unlicense, gpl, prose, "Licensed under the GNU Lesser General Public License.", "Licensed under CC BY 4.0."]
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(frame([(i, "some words\n# " + t.replace(", ", ",\n# ") + "\nmore words", None, None) for i, t in enumerate(texts)])).collect()}
    assert "mit" in got[0] and "apache-2.0" in got[1] and any("bsd-2-clause" in x for x in got[2])
    assert "isc" in got[3] and "unlicense" in got[4] and "agpl-3.0|gpl-3.0" in got[5] and got[6] == {""}
    assert "lgpl" in got[7] and got[8] == {"cc-by"}
    whole = (licenses.Path(licenses.__file__).parent / "license_texts")
    files = sorted(whole.glob("*.txt"))
    all_ = {r.doc_id: r.labels for r in licenses.scan(frame([(i, f.read_text(), None, None) for i, f in enumerate(files)])).collect()}
    assert all(f.stem in all_[i].replace("|", ",").split(",") for i, f in enumerate(files))
