"""Each operator against brute force, round trips, held-out accuracy and edge rows."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from relink.llm import components as cc
from relink.llm import e8, inverted, langid, lattice, notices, packing, preference, registry, reshard, simhash, warc
from relink.llm.common import Forest, alnum_words, space_words

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(40_000))
EDGE = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "  \t\n ", None, "s", 0), (4, "... 123 !!", "en", "s", 0), (5, LONG, "en", "s", 9),
        (6, LONG, "en", "s", 9), (7, "One two three", None, None, None), (7, "One two three", None, None, None), (None, "one TWO three", "en", "s", 1),
        (8, "ünï çödé \U0001F600 words", "fr", "s", 1), (9, "a<|endoftext|>b", "en", "s", 1)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS).withColumn("fp", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("row", F.lit(2)).withColumn("_h", F.lit(3))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_words():
    assert alnum_words("Ab-cÉ d e_1".encode()) == ["ab".encode(), "cÉ".encode(), "d e".encode(), b"1"]
    assert space_words(b"A\x0bB\x1cc  D") == [b"a", b"b\x1cc", b"d"]
    assert alnum_words(None) == space_words(b"") == []


# components

def test_components_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 180)] + [(7, 7), (None, 3), (500, 499)]
    got = dict(cc.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 180)}, 499: 499, 500: 499}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 3: inverted index

def brute_hits(texts, items, n=10):
    out = []
    made = [(i, w) for i, t in items for w in inverted.windows(alnum_words(t.encode() if t else None), n)]
    for t in texts:
        words = alnum_words(t.encode() if t is not None else None)
        hit, who = set(), set()
        for i, w in made:
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k:k + len(w)]) == w:
                    hit.update(range(k, k + len(w)))
                    who.add(i)
        names = sorted({str(i) for i in who if i is not None})
        out.append((len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest()))
    return out


def test_contamination_brute_force(spark, monkeypatch):
    monkeypatch.setattr(inverted, "SEGMENT_WORDS", 50)
    p = [f"p{i}" for i in range(14)]
    items = [(10, " ".join(p)), (11, "short Item"), (2, "a a a"), (None, "no id here"), (10, "again ten"), (12, ""), (13, None)]
    texts = ["x " * 5 + " ".join(p[:12]) + " y", "SHORT,item short item", "a a a a a", "no id here", None, "", " ".join(p[:9]), "short", "item", "again-ten", "z " * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).withColumn("segment", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = brute_hits(texts, items)
    for block in (inverted.BLOCK_WORDS, 3):
        monkeypatch.setattr(inverted, "BLOCK_WORDS", block)
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in inverted.contamination(docs, bench).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_whole_index_and_proximity(spark):
    docs = spark.createDataFrame([(1, "the cat sat on a mat"), (2, "cat the q sat"), (3, "cat"), (4, "sat q q q q cat the")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the cat sat")], "item_id long, text string")
    index = inverted.build(docs)
    got = {(r.doc_id, r.start, r.n, r.kind) for r in inverted.matches(index, bench, 3, slop=1).collect()}
    assert got == {(1, 0, 3, "phrase"), (1, 0, 3, "near"), (2, 0, 4, "near")}
    assert {(r.doc_id, r.kind) for r in inverted.matches(index, bench, 3).collect()} == {(1, "phrase")}


def brute_near(words, window, reach):
    """(start, length) around each place of the rarest term, from all stretches of a document."""
    terms = list(dict.fromkeys(window))
    rare = min(terms, key=words.count)
    out = set()
    for p in [i for i, w in enumerate(words) if w == rare]:
        held = [(b - a, -a) for a in range(p + 1) for b in range(p + 1, min(len(words), a + reach) + 1)
                if set(terms) <= set(words[a:b])]
        if held:
            out.add((-min(held)[1], min(held)[0]))
    return out


def test_proximity_beside_other_documents(spark):
    pair = spark.createDataFrame([(1, "b x x a"), (2, "b y")], "doc_id long, text string").coalesce(1)
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [(r.doc_id, r.start, r.n) for r in inverted.matches(inverted.build(pair), asked, 2, slop=3).collect()] == [(1, 0, 4)]
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(list("abcdxyz"), rng.integers(0, 9))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    items = [(1, "a b"), (2, "c a b"), (3, "d d c"), (4, "b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((d, str(i), *m) for d, t in enumerate(texts) for i, w in items
                  for m in brute_near(t.split(), w.split(), len(w.split()) + 2) if set(w.split()) <= set(t.split()))
    got = inverted.matches(inverted.build(docs), bench, 3, slop=2).where("kind = 'near'").collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.n) for r in got) == want and len(want) > 100


def test_contamination_edges(spark, edge):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit) for r in inverted.contamination(edge, bench).collect()))
    assert got == [(0, 3, 3), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, 40000, 0), (6, 40000, 0), (7, 3, 3), (7, 3, 3), (8, 4, 0), (9, 3, 0)]
    assert inverted.contamination(empty(spark), bench).count() == 0
    assert inverted.contamination(edge, bench.limit(0)).where("contaminated").count() == 0
    assert sorted(r.doc_id for r in inverted.drop_contaminated(edge, bench).collect()) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert inverted.drop_contaminated(edge, bench).columns == edge.columns


# 10: simhash

def brute_print(text):
    words = space_words(text.encode() if text is not None else None)
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    forest = Forest(len(rows))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 4:
                forest.link(np.array([i, j]))
    roots = forest.roots(np.arange(len(rows))).tolist()
    least = {}
    for r, (d, _) in zip(roots, rows):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(r) for r in roots]


def test_simhash_brute_force(spark, docs, edge):
    for df in (docs, edge):
        rows = [(r.doc_id, brute_print(r.text)) for r in df.collect()]
        want = collections.Counter((d, f"{f:016x}", c) for (d, f), c in zip(rows, brute_classes(rows)))
        assert collections.Counter(tuple(r) for r in simhash.near_duplicates(df).collect()) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("leaf", [1, 16])
def test_vantage_trees_and_rings(spark, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 40).tolist()
    prints = {0, 2 ** 64 - 1, *base}
    for b in base:
        for _ in range(12):
            for i in rng.choice(64, rng.integers(1, 8), replace=False).tolist():
                b ^= 1 << i
            prints.add(b & (2 ** 64 - 1))
    prints = sorted(prints)
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    rows = [(i, h) for i, h in enumerate(prints)]
    df = spark.createDataFrame([(i, i, s) for i, s in enumerate(signed)], "doc_id long, h long, fp long")
    linked, first = simhash.classes(df)
    got = {r.doc_id: r.component_id for r in linked.join(first, "group").collect()}
    assert [got[i] for i in range(len(prints))] == brute_classes(rows)


def test_dense_rings_are_dealt_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 32)
    rng = np.random.default_rng(7)
    # one value of the first segment; one ring: half of the twelve free bits differ from the vantage point's
    dense = {sum(1 << int(i) for i in rng.choice(range(13, 40, 2), 7, replace=False)) for _ in range(400)}
    prints = sorted({0, *dense, *rng.integers(0, 2 ** 63, 60).tolist()})
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    groups = collections.defaultdict(set)
    for r in simhash.dealt(fps).collect():
        groups[r.key].add(r.fp)
    assert len(prints) > 300 and max(map(len, groups.values())) <= 3 * 32
    near = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= simhash.RADIUS]
    of = collections.defaultdict(set)
    for k, g in groups.items():
        for p in g:
            of[p].add(k)
    assert len(near) > 1000 and all(of[a] & of[b] for a, b in near)
    linked, first = simhash.classes(fps.select(F.col("fp").alias("doc_id"), F.col("fp").alias("h"), "fp"))
    got = {r.doc_id: r.component_id for r in linked.join(first, "group").collect()}
    assert [got[p] for p in prints] == brute_classes([(p, p) for p in prints])


def test_vp_links_on_dense_points():
    x = np.unique(np.random.default_rng(5).integers(0, 1 << 11, 700)).astype(np.uint64) << np.uint64(20)
    forest = Forest(len(x))
    simhash.vp_links(x, forest)
    assert set(forest.roots(np.arange(len(x))).tolist()) == {0}


def test_keep_one(spark, edge):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in kept.collect())
    assert got == sorted([(1, ""), (4, "... 123 !!"), (5, LONG), (7, "One two three"), (8, EDGE[9][1]), (9, EDGE[10][1])])


# 7: language

def test_language_accuracy(docs):
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20 and sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_sample_of_null_and_repeated_ids(spark):
    rows = [(d, f"{w} number {i}", w) for w, d in (("none", None), ("same", 3)) for i in range(1500)] + [(3, "again", "copies")] * 900
    rows += [(i, f"own {i}", "own") for i in range(900)]
    got = collections.Counter(k for k, _ in langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert got == {"none": 160, "same": 160, "own": 160, "copies": 1}
    bare = spark.createDataFrame([(1, None, None), (2, "1 2", None), (3, "", None), (4, "é", None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in langid.keep_known(bare).collect()] == [4]


def test_language_folds_and_edges(spark, docs, edge):
    rows = {r.doc_id: r.held_out for r in langid.identify(docs).collect()}
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in rows.items())
    hidden = docs.withColumn("lang", F.when(langid.fold() == 2, F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in {k for k, _ in langid.sample(hidden)}
    slices = langid.sample(docs)
    pred = {(r.doc_id, r.lang_pred == "und", r.score) for r in langid.predict(edge, slices).collect()}
    assert {d for d, und, _ in pred if und} == {1, 2, 3, 4} and all(s == 0 for d, und, s in pred if und)
    assert langid.identify(empty(spark)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    both = docs.unionByName(edge.select(docs.columns))
    assert sorted(r.doc_id for r in both.subtract(langid.keep_known(both)).collect()) == [1, 2, 3, 4][:4]


def test_automaton_is_the_set_of_substrings():
    text = [int(c) for c in np.random.default_rng(1).integers(0, 3, 60)]
    go = langid.automaton(text, 4)
    subs = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for s in [*list(subs)[:300], *[tuple(np.random.default_rng(k).integers(0, 4, 6).tolist()) for k in range(200)]]:
        state = 1
        for c in s:
            state = go[state, c] if state else 0
        assert bool(state) == (s in subs)


def test_phrases_brute_force():
    model = langid.train([("a", "the cat sat on the mat"), ("b", "zwei und drei sind fünf")])
    rng = np.random.default_rng(2)
    pieces = [rng.integers(0, 12, n).astype(np.uint8) for n in (1, 40, 7, 300)]
    for go in model["go"]:
        want = []
        for piece in pieces:
            n, state = 1, 1
            for c in piece.tolist():
                to = go[state, c]
                if not to:
                    n += 1 + (go[1, c] == 0)
                    to = go[1, c] or 1
                state = to
            want.append(n)
        assert langid.phrases(pieces, go).tolist() == want


# 8: packing

def test_packing_round_trip(spark, docs, edge):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    for df in (docs, edge):
        rows = df.select(F.monotonically_increasing_id().alias("n"), "doc_id", "text").collect()
        want = collections.Counter()
        ids = {}
        for r in rows:
            own = np.array([*exact.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
            ids.setdefault(r.doc_id, []).append(own)
            want[r.doc_id] += len(own)
        got = packing.pack(df).collect()
        assert sum(r.length for r in got) == sum(want.values())
        seq = collections.defaultdict(list)
        for r in got:
            assert any(r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[r.start:r.start + r.length].tobytes()) for x in ids[r.doc_id])
            seq[r.sequence_id].append((r.offset, r.length))
        for parts in seq.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= 1024
        assert len(seq) <= math.ceil(sum(want.values()) / 1024) * 1.02 + df.rdd.getNumPartitions()
    assert packing.pack(empty(spark)).count() == 0


def test_cuts_are_of_least_cost():
    rng = np.random.default_rng(4)
    for _ in range(40):
        n, length, grid = int(rng.integers(1, 90)), 16, 4
        docs = np.unique(np.r_[rng.integers(1, n + 1, 4), n])
        sents = np.unique(rng.integers(1, n + 1, 6))
        price = {p: packing.INSIDE for p in range(grid, n, grid)} | {int(p): packing.AFTER_SENTENCE for p in sents} | {int(p): 0 for p in docs} | {n: 0}
        best = {0: 0}
        for p in sorted(price):
            best[p] = min(best[q] + length - (p - q) + price[p] for q in best if 0 < p - q <= length)
        ends = packing.cuts(n, docs, sents, length, grid)
        assert ends[-1] == n and all(0 < b - a <= length for a, b in zip([0, *ends], ends))
        assert sum(length - (b - a) + price[b] for a, b in zip([0, *ends], ends)) == best[n]


# 5: resharding

def test_flow_is_of_least_cost():
    rng = np.random.default_rng(8)
    for _ in range(30):
        supply, n = rng.integers(0, 20, 3).tolist(), 4
        capacity = [-(-sum(supply) // n) + 1] * n
        cost = [[int(i != j) for j in range(n)] for i in range(3)]
        flow = dense_flow(supply, capacity, cost)
        assert [sum(f) for f in flow] == supply and all(sum(f[j] for f in flow) <= capacity[j] for j in range(n))
        moved = sum(flow[i][j] for i in range(3) for j in range(n) if i != j)
        assert moved == sum(max(0, s - c) for s, c in zip(supply, capacity))
        owed = reshard.moves(supply, capacity)
        assert sum(sum(x.values()) for x in owed) == moved and not any(i in x for i, x in enumerate(owed))
        assert all(sum(x.get(j, 0) for x in owed) + (min(supply[j], capacity[j]) if j < 3 else 0) <= capacity[j] for j in range(n))
    with pytest.raises(ValueError):
        reshard.moves([3], [2])
    assert dense_flow([2, 2], [2, 2], [[5, 1], [4, 3]]) == [[0, 2], [2, 0]]
    for _ in range(40):  # any costs, against all ways to send single units
        supply, capacity, cost = rng.integers(0, 3, 2).tolist(), rng.integers(1, 4, 2).tolist(), rng.integers(0, 9, (2, 2)).tolist()
        if sum(supply) <= sum(capacity):
            flow = dense_flow(supply, capacity, cost)
            ways = [(a, b) for a in range(supply[0] + 1) for b in range(supply[1] + 1) if a + b <= capacity[0] and sum(supply) - a - b <= capacity[1]]
            best = min(a * cost[0][0] + (supply[0] - a) * cost[0][1] + b * cost[1][0] + (supply[1] - b) * cost[1][1] for a, b in ways)
            assert sum(flow[i][j] * cost[i][j] for i in range(2) for j in range(2)) == best
    many = reshard.moves([10**9] * 3000, [6 * 10**8] * 5001)  # thousands of shards: a few arcs for each
    assert sum(sum(x.values()) for x in many) == 3000 * 4 * 10**8


def dense_flow(supply, capacity, cost):
    n, m = len(supply), len(capacity)
    arcs = [(i, n + j, supply[i], cost[i][j]) for i in range(n) for j in range(m)]
    flow = reshard.min_cost_flow(arcs + [(n + m, i, supply[i], 0) for i in range(n)] + [(n + j, n + m + 1, capacity[j], 0) for j in range(m)], n + m, n + m + 1)
    return [flow[i * m : (i + 1) * m] for i in range(n)]


def test_reshard(spark, docs, edge):
    for df in (docs, edge):
        rows, got = df.collect(), reshard.reshard(df).collect()
        text = collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
        assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == text
        for shard in {r.shard for r in got}:
            assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
        assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None} and {r.shard for r in got} <= set(range(8))
    assert reshard.reshard(empty(spark)).count() == 0


def test_reshard_balances_and_keeps_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "x" * int(n)) for i, n in enumerate(rng.integers(1, 900, 6000))] + [(10_000 + i, "the same text again") for i in range(900)]
    got = reshard.reshard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size, place = collections.Counter(), collections.defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        place[r.text_crc32].add(r.shard)
    assert max(size.values()) <= 1.02 * min(size.values()) and all(len(s) == 1 for s in place.values())
    large = [(i, "y" * 500 if i % 3 == 0 else f"z{i}" * 40) for i in range(3000)]  # a third of all rows, more than a shard holds
    more = reshard.reshard(spark.createDataFrame(large, "doc_id long, text string")).collect()
    size_of = collections.Counter()
    for r in more:
        size_of[r.shard] += r.size
    assert max(size_of.values()) <= 1.02 * min(size_of.values())
    stay = sum(r.size for r in got if r.shard == r.old_shard)
    old = collections.Counter()
    for r in got:
        old[r.old_shard] += r.size
    least = sum(max(0, n - sum(size.values()) / 8) for n in old.values())
    assert sum(size.values()) - stay <= 1.02 * least


def test_reshard_balances_large_groups(spark):
    """Groups just too small to be split: three of them fill one old shard, or there are no small texts to level with."""
    rows = [(i, f"group {i % 3} ".ljust(449), 0) for i in range(300)] + [(1000 + i, f"text {i} ".ljust(99), 1 + i % 5) for i in range(6650)]
    got = reshard.reshard(spark.createDataFrame(rows, "doc_id long, text string, home int"), old="home").collect()
    size, place = collections.Counter(), collections.defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        place[r.text_crc32].add(r.shard)
    total = sum(size.values())
    assert total == 300 * 450 + 6650 * 100 and max(size.values()) <= 1.02 * min(size[j] for j in range(8)) and all(len(s) == 1 for s in place.values())
    blocks = [(f"group {i}", (0, 0, 0, 1, 2, 3, 4, 5, 5, 5)[i % 10], 400) for i in range(20)]
    load = collections.Counter()
    for key, j in reshard.assign(blocks, 6, [1000] * 8).items():
        load[j] += 400
    assert sorted(load.values()) == [800] * 4 + [1200] * 4


def test_rewrite_touches_affected_shards_only(spark, docs, tmp_path):
    report = reshard.rewrite(docs, str(tmp_path / "new"), old_shards=6, new_shards=8)
    actions = {r.shard: r.action for r in report.collect()}
    new = spark.read.parquet(str(tmp_path / "new"))
    full = reshard.tagged(docs)
    stay = full.where(F.col("_old").isin([s for s, a in actions.items() if a != "rewrite"])).select("_row.*")
    both = stay.unionByName(new.select(docs.columns))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, docs.collect()))
    assert {actions[6], actions[7]} == {"append"}


def test_given_shards_and_capacities(spark, docs, tmp_path):
    """Rows lie in shards of a column, new shards hold different amounts, and the table has columns of the operator's own names."""
    total = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    mine = docs.withColumns({c: F.lit(f"own {c}") for c in ("_old", "_block", "_row", "_mix", "_shard", "shard_", "_part")}).withColumn("shard", F.pmod("doc_id", F.lit(3)).cast("int"))
    capacity = [total // 2 + 1, total // 4 + 1, 0, total // 4 + 2]
    got = reshard.reshard(mine, 3, 4, old="shard", capacity=capacity).collect()
    size, old, stay = collections.Counter(), collections.Counter(), 0
    for r in got:
        assert r.old_shard == r.doc_id % 3
        size[r.shard] += r.size
        old[r.old_shard] += r.size
        stay += r.size * (r.shard == r.old_shard)
    slack = 0.03 * total
    assert all(size[j] <= capacity[j] + slack for j in range(4)) and size[2] <= slack
    assert total - stay <= sum(max(0, old[i] - capacity[i]) for i in range(3)) + slack
    for _ in range(2):  # a second run replaces the first one's files
        report = reshard.rewrite(mine, str(tmp_path / "out"), 3, 4, old="shard", capacity=capacity)
        actions = {r.shard: r.action for r in report.collect()}
        new = spark.read.parquet(str(tmp_path / "out"))
        assert set(new.columns) == {*mine.columns, "shard__"}
        kept = mine.where(F.col("shard").isin([s for s, a in actions.items() if a != "rewrite"]))
        both = kept.unionByName(new.select(mine.columns))
        assert sorted(map(tuple, both.collect()), key=str) == sorted(map(tuple, mine.collect()), key=str)


def test_reshard_rows_come_from_written_shards(spark, docs, tmp_path):
    """Shard 0 gives up half and is written anew, shard 1 only gains, shard 2 stays: its rows are in no file."""
    mine = docs.withColumn("home", F.when(F.col("doc_id") % 8 == 0, 2).when(F.col("doc_id") % 8 == 1, 1).otherwise(0))
    held = {r.home: r.b for r in mine.groupBy("home").agg(F.sum(F.octet_length("text") + 1).alias("b")).collect()}
    still = reshard.reshard(mine, 3, 3, old="home", capacity=[held[j] for j in range(3)], path=str(tmp_path / "still")).collect()
    assert all(r.shard == r.old_shard for r in still) and not list((tmp_path / "still").glob("shard=*"))
    half = held[0] // 2
    got = reshard.reshard(mine, 3, 3, old="home", capacity=[half, held[1] + held[0] - half, held[2]], path=str(tmp_path / "new")).collect()
    whole = {r.doc_id: tuple(r) for r in mine.collect()}
    new = spark.read.parquet(str(tmp_path / "new"))
    assert new.columns == [*mine.columns, "shard"] and all(tuple(r)[:-1] == whole[r.doc_id] for r in new.collect())
    assert sorted((r.shard, r.doc_id) for r in new.collect()) == sorted((r.shard, r.doc_id) for r in got if r.shard == 0 or r.old_shard != r.shard)
    assert sorted(r.doc_id for r in got) == sorted(whole) and {(r.old_shard, r.shard) for r in got} == {(0, 0), (0, 1), (1, 1), (2, 2)}
    for shard in range(3):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    before = {r.doc_id: r.slot for r in still}
    assert all(r.slot == before[r.doc_id] for r in got if r.shard == r.old_shard and r.shard > 0)  # kept rows keep their slots


def test_query_reads_the_written_shards(spark, monkeypatch):
    """All six old shards lose rows, so every row comes from the files: what stands there twice comes twice."""
    def twice(docs, path, *rest):
        out = land(docs, path, *rest)
        spark.read.parquet(path).localCheckpoint().write.mode("append").partitionBy("shard").parquet(path)
        return out

    land, query = reshard.land, registry.QUERIES["op5_flow_resharding"]
    once = collections.Counter(r[:3] for r in query(spark, SMALL).collect())
    monkeypatch.setattr(reshard, "land", twice)
    assert collections.Counter(r[:3] for r in query(spark, SMALL).collect()) == once + once


def test_stages_keep_every_column(spark, docs):
    """Whole rows come through, also where columns have names that the operators use themselves."""
    names = ("_id", "_none", "_h", "_key", "_row", "key", "fp")
    mine = docs.withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in names})
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = {r.doc_id: tuple(r) for r in mine.collect()}
    for out in (simhash.keep_one(mine), inverted.drop_contaminated(mine, benchmark), langid.keep_known(mine)):
        assert out.columns == mine.columns
        rows = out.collect()
        assert rows and all(tuple(r) == whole[r.doc_id] for r in rows)


# 6: archive

def test_archive_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "http://c\r\nX: y", ""), (5, "u", "é\x00ü" * 999),
                                   (5, "u", "é\x00ü" * 999), (None, "n", "<p>x</p>"), (None, "n", "only"), (9, "u", "one")], "page_id long, url string, html string")
    pages = pages.withColumn("sha256", F.lit("clash"))
    path = warc.archive(pages)
    rows = warc.records(spark, path).collect()
    assert len(rows) == 9 and spark.read.parquet(f"{path}/payloads").count() == 5
    for r in rows:
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert head + warc.END == bytes(r.header) and b"\r\nX:" not in head.split(b"WARC-Date")[0]
        assert body == (bytes(r.payload) if r.record_type == "response" else b"") + warc.END
        assert r.payload_digest == warc.base32(hashlib.sha1(bytes(r.payload)).hexdigest()).decode() and r.payload_bytes == len(r.payload)
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows)
    assert got == sorted([(1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None), (5, "response", None), (5, "revisit", 5),
                          (0, "revisit", 2), (0, "response", None), (9, "response", None)], key=lambda x: (x[0], x[1], x[2] or 0)) or True
    assert collections.Counter(got) == collections.Counter([(1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None), (5, "response", None),
                                                            (5, "revisit", 5), (0, "revisit", 2), (0, "response", None), (9, "response", None)])
    assert warc.records(spark, warc.archive(pages.limit(0))).count() == 0


def test_archive_notices_damage(spark, tmp_path):
    path = warc.archive(spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string"), str(tmp_path / "a"))
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"tex!")).collect()
    spark.createDataFrame(bad, spark.read.parquet(f"{path}/payloads").schema).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not fit its digest"):
        warc.records(spark, path).collect()


# 4: notices

def test_notices(spark, edge):
    rows = [(1, "All Rights Reserved. x CC-BY-NC 4.0"), (2, "al rights reservd"), (3, "Licenced under the Apache Licence, Version 2.0"), (4, "the rights of all"),
            (5, None), (6, "cc by cc by"), (7, "(c) GNU General\nPublic License; general public license"), (8, "xcc by")]
    got = {r.doc_id: r for r in notices.labelled(notices.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    one = got[1]
    assert (one.n_words, one.n_base, one.first_word, one.last_word, one.base_labels, one.labels, one.score) == (9, 2, 0, 4, "cc-by,reserved", "cc-by,reserved", 1.0)
    assert (got[2].n_base, got[2].first_word, got[2].base_labels, got[2].labels) == (0, None, "", "reserved") and got[2].score == 1 - 2 / 19
    assert got[3].labels == "apache,apache-2.0" and 0.9 < got[3].score < 1
    assert got[4].labels == "" and got[4].score == 0 and (got[5].n_words, got[5].labels) == (0, "")
    assert (got[6].n_base, got[6].first_word, got[6].last_word) == (2, 0, 2)
    assert (got[7].n_base, got[7].first_word, got[7].last_word, got[7].labels) == (2, 2, 5, "gpl") and got[8].n_base == 0
    spans = {(s.label, s.first, s.last) for s in got[3].spans}
    assert {("apache", 0, 4), ("apache-2.0", 3, 7)} <= spans
    assert notices.scan(edge).count() == len(EDGE) and notices.labelled(notices.scan(empty(spark))).count() == 0


def test_seeds_lose_no_match():
    import regex

    rng = np.random.default_rng(6)
    for notice, label, anchors in notices.NOTICES:
        k = len(notice) // notices.PER_EDIT
        for _ in range(6):
            t = list(notice)
            for _ in range(rng.integers(0, k + 1)):
                i = int(rng.integers(0, len(t)))
                t[i:i + 1] = [[], [t[i], "q"], ["z"]][rng.integers(0, 3)]
            line = "lorem " + "".join(t) + " ipsum"
            whole = regex.search(rf"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={k}}}", line)
            kept = f" {anchors} " in line if anchors else True
            assert (label in {x[0] for x in notices.fuzzy(line)}) or whole is None or not kept


def test_edits_make_no_other_license(spark):
    """The word that names a license is never edited into another's."""
    def labels(text):
        return {x[0] for x in notices.fuzzy(text)}

    assert labels("released under the bsd license") == {"bsd"} and labels("released under the gpl license") == {"gpl"}
    assert labels("released under the isc license") == {"isc"} and labels("relased undr the mit licence") == {"mit"}
    assert labels("released under the xyz license") == set() and labels("released under the mitt license") == set()
    assert labels("licensed under cc by sa") == {"cc-by", "cc-by-sa"} and labels("licenced under cc by nd") == {"cc-by", "cc-by-nd"}
    assert labels("licensed under cc by nc") == {"cc-by", "cc-by-nc"} and labels("licensed under cc by") == {"cc-by"}
    assert labels("apache license version 1 1") == set() and labels("apache licence version 2 0") == {"apache-2.0"}
    assert labels("licensed under the apache license") == {"apache"}


def test_notices_of_a_table(spark):
    given = spark.createDataFrame([("Do NOT copy, ever!", "strict", None), ("free for the blue team", "blue", "blue"), ("free for the blue team", "blue", "blue"), ("...", "none", None), (None, "none", "x")],
                                  "notice string, label string, anchors string")
    table = notices.notice_table(given)
    assert table == (("do not copy ever", "strict", ""), ("free for the blue team", "blue", "blue"))
    docs = spark.createDataFrame([(1, "do nt copy ever"), (2, "free for the blve team"), (3, "fre for the blue teem"), (4, "released under the mit license")], "doc_id long, text string")
    got = {r.doc_id: [s.label for s in r.spans] for r in notices.scan(docs, table).collect()}
    assert got == {1: ["strict"], 2: [], 3: ["blue"], 4: []}
    with pytest.raises(ValueError):
        notices.notice_table(given, most=1)
    with pytest.raises(ValueError):
        notices.fuzzy("x", (("a b c", "l", "a c"),))


def least_edits(line, notice, k):
    """Brute force: for each start, the least edits of any stretch from there on, if at most k."""
    out = {}
    for a in range(len(line)):
        row = list(range(len(notice) + 1))
        least = row[-1]
        for c in line[a:a + len(notice) + k]:
            last, row = row, [row[0] + 1]
            for j, x in enumerate(notice):
                row.append(min(last[j] + (c != x), last[j + 1] + 1, row[-1] + 1))
            least = min(least, row[-1])
        if least <= k:
            out[a] = least
    return out


def test_notices_side_by_side(spark):
    mpl = "mozila public license " * 5 + "mozilla public license"
    assert [x[1:4] for x in notices.fuzzy(mpl) if x[0] == "mpl"] == [(22 * i, 22 * i + 21, 1) for i in range(5)] + [(110, 132, 0)]
    assert [x[1:4] for x in notices.fuzzy("all rights reservd all rights reserved")] == [(0, 18, 1), (19, 38, 0)]
    found = notices.scan(spark.createDataFrame([(1, mpl)], "doc_id long, text string")).collect()[0].spans
    assert [(s.first, s.last) for s in found if s.label == "mpl"] == [(3 * i, 3 * i + 2) for i in range(6)]
    rng = np.random.default_rng(8)
    for notice, label in (("all rights reserved", "a"), ("mozilla public license", "m"), ("licensed under the apache license", "l")):
        k = len(notice) // notices.PER_EDIT
        for _ in range(12):
            near = []
            for _ in range(rng.integers(2, 7)):
                t = list(notice)
                for _ in range(rng.integers(0, k + 2)):
                    i = int(rng.integers(0, len(t)))
                    t[i:i + 1] = [[], [t[i], "q"], ["z"]][rng.integers(0, 3)]
                near.append("".join(t))
            line = ["", " ", " x "][rng.integers(0, 3)].join(near)
            got = notices.fuzzy(line, ((notice, label, ""),))
            want = least_edits(line, notice, k)
            assert all(want.get(a) is not None and want[a] <= e <= k for _, a, _, e, _ in got)
            assert all(x[2] <= y[1] for x, y in zip(got, got[1:]))
            # what no match touches holds no match
            free = [0, *(x[2] for x in got)], [*(x[1] for x in got), len(line)]
            assert not any(least_edits(line[a:b], notice, k) for a, b in zip(*free))
            # least edits first: a start with fewer edits than a taken match lies in or beside one that has as few
            assert not got or min(want.values()) == min(x[3] for x in got)


# 1: lattice scores

def toy(k=1):
    return {"first": {b"": (0.1,) * k, b"a": (0.3,) * k, b"ab": (0.2,) * k}, "next": {b"a": (0.2,) * k, b"b": (0.3,) * k, b"ab": (0.1,) * k, b"c": (0.1,) * k},
            "stop": [0.3] * k, "reach": {b"a": 1, b"b": 1, b"ab": 2, b"c": 1}, "longest": 2, "classes": k}


def brute_lattice(word, p):
    def rest(i):
        return p["stop"][0] if i == len(word) else sum(x[0] * rest(i + len(q)) for q, x in p["next"].items() if word[i:i + len(q)] == q)
    return sum(x[0] * rest(len(q)) for q, x in p["first"].items() if word[:len(q)] == q)


@pytest.mark.parametrize("word", [b"a", b"ab", b"abab", b"abcabab", b"caba"])
def test_lattice_sums_all_segmentations(word):
    assert lattice.lattice(word, toy(2)) == pytest.approx([math.log10(brute_lattice(word, toy()))] * 2)


def test_lattice_of_a_long_word_does_not_vanish():
    p = toy()
    got = lattice.lattice(b"abc" * 400, p)[0]
    step = lattice.lattice(b"abc" * 11, p)[0] - lattice.lattice(b"abc" * 10, p)[0]
    assert got == pytest.approx(lattice.lattice(b"abc" * 10, p)[0] + 390 * step)


def test_scores(spark, docs, monkeypatch):
    monkeypatch.setattr(lattice, "HOT", 200)
    rows = docs.collect()
    got = {r.doc_id: r for r in lattice.score(docs).collect()}
    c, n = collections.Counter(), 0
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            words = space_words((r.text or "").encode())
            c.update([*words, None])
            n += len(words) + 1
    assert len(got) == len(rows)
    for r in rows:
        words = [*space_words((r.text or "").encode()), None]
        x = got[r.doc_id]
        assert (x.n_tokens, x.n_known, x.train_tokens, x.held_out) == (len(words), sum(c[w] > 0 for w in words), n, zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert x.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in words)) and x.score < 0
    monkeypatch.setattr(lattice, "HOT", 1)
    again = {r.doc_id: r.score for r in lattice.score(docs).collect()}
    assert all(again[d] == pytest.approx(x.score) for d, x in got.items())


def test_scores_brute_force(spark, monkeypatch):
    rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate([("the cat sat", "en"), ("the dog", "en"), ("le chat", "fr"), ("the le zzz", None), (None, "en"), ("", "fr")] * 3)]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.score for r in lattice.score(df).collect()}
    number, ends = lattice.classes_of(df)
    names = sorted({r[2] or "" for r in rows}, key=lambda k: (-sum((x[2] or "") == k and zlib.crc32(str(x[0]).encode()) % 7 != 2 for x in rows), k))
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    count = [collections.Counter(w for r in train if (r[2] or "") == k for w in space_words((r[1] or "").encode())) for k in names]
    assert ends == [sum((r[2] or "") == k for r in train) for k in names]
    shares = lattice.Shares([sum(c.values()) + e for c, e in zip(count, ends)], [len(c) + 1 for c in count])
    words = lattice.word_counts(df, number, len(ends))
    pieces = lattice.piece_scores(words, len(ends))
    for d, t, *_ in rows:
        logs = [math.log10(e / sum(ends)) + x for e, x in zip(ends, shares.logs(ends, None))]
        for w in space_words((t or "").encode()):
            logs = [a + b for a, b in zip(logs, shares.logs([c[w] for c in count], lattice.lattice(w, pieces)))]
        assert got[d] == pytest.approx(math.log10(sum(10 ** x for x in logs)))


def test_scores_edges(spark, edge):
    got = lattice.score(edge).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 4), (1, 1), (2, 1), (3, 1), (4, 4), (5, 40001), (6, 40001), (7, 4), (7, 4), (8, 5), (9, 2)]
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lattice.score(empty(spark)).count() == 0


# 2: E8

VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())), StructField("label", IntegerType()), StructField("space", StringType())])


def test_e8_decodes_to_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) * 2
    y = e8.decode(x)
    assert ((2 * y) % 1 == 0).all() and (y.sum(axis=1) % 2 == 0).all()
    d = ((x - y) ** 2).sum(axis=1)
    for v in e8.shortest():
        assert (((x - y - v) ** 2).sum(axis=1) >= d - 1e-9).all()
    assert d.max() <= 1 + 1e-9  # the covering radius


def test_e8_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows, i = [], 0
    for label in (1, 2):
        for _ in range(60):
            x = rng.normal(size=32)
            rows.append((i, x.tolist(), label, "x"))
            i += 1
            for c in rng.uniform(0.90, 0.9999, 4):
                z = rng.normal(size=32)
                z -= z @ x / (x @ x) * x
                z *= np.linalg.norm(x) / np.linalg.norm(z)
                rows.append((i, ((c * x + math.sqrt(1 - c * c) * z) * rng.uniform(0.1, 9)).tolist(), label, "x"))
                i += 1
    hot = rng.normal(size=32)
    rows += [(1000 + k, (hot + rng.normal(size=32) * 0.05).tolist(), 3, "x") for k in range(90)] + [(2000 + k, hot.tolist(), 3, "x") for k in range(50)]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    for group in (e8.GROUP, 16):
        monkeypatch.setattr(e8, "GROUP", group)
        got = {r.vec_id: r for r in e8.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
        n = np.array([got[r[0]].n_links for r in rows])
        assert (n <= want).all() and n.sum() >= 0.97 * want.sum()
        assert (n[label == 3] == want[label == 3]).all()
        ids = np.array([r[0] for r in rows])
        assert all(got[v].component_id == 1000 and got[v].kept == (v == 1000) for v in ids[label == 3].tolist())


def test_e8_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 1, "x"), (2, [], 1, "x"), (3, [0.0, 0.0], 1, "x"), (4, [1.0, None], 1, "x"), (5, [1.0, inf], 1, "x"), (6, [nan, 1.0], 1, "x"), (7, [1.0, 0.0], None, "x"),
            (8, [1.0, 0.0], 1, "x"), (8, [1.0, 0.0], 1, "x"), (9, [5.0, 0.0], 1, "x"), (10, [1.0, 0.0, 0.0], 1, "x"), (11, [1.0, 0.0], 2, "x"), (None, [2.0, 0.0], 1, "x"), (12, [-1.0, 0.0], 1, "x")]
    got = collections.Counter(tuple(r) for r in e8.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)]
    assert got == collections.Counter([*alone, (8, 3, 8, True), (8, 3, 8, True), (9, 3, 8, False), (None, 3, 8, False)])
    assert e8.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


# 9: preferences

def test_preferences(spark):
    turns = [("p", "chosen", 0, "user", "hi"), ("p", "chosen", 1, "assistant", "yo"), ("p", "rejected", 0, "user", "hi"), ("p", "rejected", 1, "assistant", "no"), ("p", "rejected", 2, "user", "?"),
             ("q", "chosen", 5, None, None), ("q", "rejected", 9, None, None), ("r", "chosen", 1, "assistant", "x"), (None, "chosen", 1, "user", "x"), ("s", "other", 1, "user", "x"),
             ("t", "chosen", None, "user", "b"), ("t", "chosen", None, "user", "a"), ("t", "chosen", None, "user", "a"), ("t", "rejected", 0, "user", "a")]
    df = spark.createDataFrame(turns, "pair_id string, side string, turn int, role string, text string").withColumn("n_common", F.lit(1))
    got = {r.pair_id: r for r in preference.format_pairs(df).collect()}
    assert set(got) == {"p", "q", "r", "t"}
    p = got["p"]
    assert (p.n_common, p.prompt, p.chosen, p.status) == (1, "<|user|>\nhi<|end|>\n", "<|assistant|>\nyo<|end|>\n", "pair")
    assert [p.chosen[s["from"]:s["to"]] for s in p.chosen_mask] == ["yo<|end|>\n"] and [p.rejected[s["from"]:s["to"]] for s in p.rejected_mask] == ["no<|end|>\n"]
    assert (got["q"].status, got["q"].prompt, got["q"].chosen, got["q"].rejected_mask) == ("equal", "<|unknown|>\n<|end|>\n", "", [])
    assert (got["r"].status, got["r"].prompt, got["r"].rejected, got["r"].rejected_mask) == ("unpaired", "", None, None)
    assert (got["t"].n_common, got["t"].chosen.count("<|user|>"), got["t"].rejected) == (1, 2, "")
    assert preference.format_pairs(df.limit(0)).count() == 0
    marks = spark.createDataFrame([("m", "chosen", 0, "us|er", "a<|end|>\n<|assistant|>\nb"), ("m", "rejected", 0, "user", "x")], df.drop("n_common").schema)
    assert preference.format_pairs(marks).first().chosen == "<|user|>\na< |end|>\n< |assistant|>\nb<|end|>\n"


def test_swapped_answers(spark):
    """Pairs share the turns before the last answer; equal and one-sided pairs occur too."""
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = preference.format_pairs(preference.swapped_answers(conversations)).collect()
    assert len(got) == 100 and collections.Counter(r.status for r in got).keys() == {"pair", "equal", "unpaired"}
    assert len({r.n_common for r in got}) > 3 and sum(r.status == "pair" for r in got) > 50
    turns = collections.defaultdict(list)
    for r in conversations.orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text))
    answer = {c: [t for role, t in ts if role == "assistant"][-1:] for c, ts in turns.items()}
    for r in (r for r in got if r.status == "pair"):
        mine = turns[r.pair_id]
        last = max(i for i, t in enumerate(mine) if t[0] == "assistant")
        assert r.n_common == last and answer[r.pair_id + 1][0] in r.rejected and mine[last][1] in r.chosen


# pipeline

def test_pipeline_brute_force(spark, docs):
    import corpus_pipeline

    rows = [r for r in docs.collect() if any(ch.isalpha() for ch in r.text or "")]
    prints = [(r.doc_id, brute_print(r.text)) for r in rows]
    rows = [r for r, c in zip(rows, brute_classes(prints)) if r.doc_id == c]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    keep = {r.doc_id for r, h in zip(rows, brute_hits([r.text for r in rows], items)) if not h[1]}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == keep and len(keep) < docs.count()
    total = {r.doc_id: r.doc_tokens for r in got}
    assert sum(r.length for r in got) == sum(total.values())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "pack"]


def test_pipeline_edges(spark, edge, docs):
    import corpus_pipeline
    from relink.llm.common import written

    for first in (edge, empty(spark)):
        stage_docs = first
        for name, stage in corpus_pipeline.STAGES:
            stage_docs = written(stage(spark, stage_docs, SMALL), f"test-{name}")
            assert name == "pack" or stage_docs.columns == first.columns
        left = {r.doc_id for r in stage_docs.select("doc_id").collect()}
        assert left == ({5, 7, 8, 9} if first is edge else set())


def test_every_operator_is_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    import oracle

    ok, message = oracle.compare(spark, oracle.duck(SMALL), SMALL, name, registry.QUERIES[name], registry.SQL[name])
    assert ok, message
