"""The prefix trie, the hash tree and the lexical search against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from articlespark.llm import lexical, prefix_trie, queries, sharding

TURNS = "conv_id long, turn long, role string, text string"


def conversations(seed=5, n=60):
    """Shared openings of several depths, whole copies, one conversation inside another, a long one, odd values."""
    rnd = random.Random(seed)
    openings = [[("system", "be brief")] + [(rnd.choice(["user", "assistant"]), cases.prose(rnd, 3)) for _ in range(5)] for _ in range(3)]
    rows = []
    for c in range(n):
        said = openings[rnd.choice([0, 0, 0, 1, 2])][:rnd.randint(0, 6)]
        said = said + [(rnd.choice(["user", "assistant"]), rnd.choice(["yes", "no", cases.prose(rnd, 2)])) for _ in range(rnd.randint(0, 4))]
        rows += [(c * 7, t * 3, *turn) for t, turn in enumerate(said or [("user", "hi")])]
    rows += [(1000, t, "user", f"line {t}") for t in range(2500)] + [(1001, t, "user", f"line {t}") for t in range(2400)]
    rows += [(1002, None, None, None), (1002, 1, "user", "é̂ 😀"), (1003, 1, "", ""), (1003, 2, "user", "é̂ 😀"), (None, 1, "user", "x"),
             (-5, 1, "user", "hi"), (1004, 1, "same", "row"), (1004, 1, "same", "row"), (1005, 1, "us", "erhi"), (1006, 1, "user", "hi")]
    return rows


def rebuilt(rows):
    """Turns per conversation in order, nulls as empty."""
    by_conv = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            by_conv[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    return {c: [t[3:] for t in sorted(said)] for c, said in by_conv.items()}


def spliced(convs, family, heads):
    out = {}
    for c, said in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        out[c] = convs.get(c - int(math.fmod(c, family)), [])[:h] + said[h:]
    return out


def trie(convs):
    """{(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, digest)} by walking explicit nodes."""
    nodes = {}
    for c, said in convs.items():
        node, above = (), None
        for d in range(len(said) + 1):
            state = nodes.setdefault(node, {"members": [], "ends": [], "kids": set(), "above": above, "last": said[d - 1][1] if d else "", "d": d})
            state["members"].append(c)
            if d < len(said):
                above, node = node, (hash(node), said[d])
                state["kids"].add(node)
        state["ends"].append(c)
    for state in nodes.values():
        state["leaves"], state["saved"] = 0, 0
    for key, state in sorted(nodes.items(), key=lambda x: -x[1]["d"]):
        state["leaves"] += not state["kids"]
        state["saved"] += (len(state["members"]) - 1) * len(state["last"])
        if state["above"] is not None:
            nodes[state["above"]]["leaves"] += state["leaves"]
            nodes[state["above"]]["saved"] += state["saved"]
    return sorted((min(s["members"]), s["d"], None if s["above"] is None else min(nodes[s["above"]]["members"]), len(s["members"]), len(s["kids"]),
                   s["leaves"], s["saved"], hashlib.sha256(",".join(map(str, sorted(s["ends"]))).encode()).hexdigest()) for s in nodes.values())


@pytest.mark.parametrize("bits", [None, 5, 11])
def test_trie_equals_a_walk_over_explicit_nodes(spark, monkeypatch, bits):
    if bits:  # a sketch so small that most estimates are wrong
        monkeypatch.setattr(prefix_trie, "BLOCK_BITS", bits)
        monkeypatch.setattr(prefix_trie, "MAX_CELL_BITS", bits)
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({c: F.lit("x") for c in cases.CLASHING + ["depth", "a", "b", "content"]})
    assert sorted(tuple(r) for r in prefix_trie.prefix_trie(df).collect()) == trie(rebuilt(rows))


def test_spliced_conversations(spark):
    rows = conversations(seed=9, n=80) + [(300, 1, "user", "alone"), (205, 1, "user", "one")]
    turns = prefix_trie.digested(spark.createDataFrame(rows, TURNS).repartition(4))
    want = trie(spliced(rebuilt(rows), 100, 6))
    assert sorted(tuple(r) for r in prefix_trie.build(prefix_trie.spliced(turns, 100, 6)).collect()) == want
    assert any(row[1] == 0 and row[-1] != prefix_trie.EMPTY for row in want)  # one ends without turns


def test_many_ends_at_one_node(spark):
    rows = [(c, 0, "user", "hi") for c in range(3000)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(7)).collect()
    assert sorted(tuple(r) for r in got) == trie(rebuilt(rows))


def test_trie_text_and_empty_table(spark):
    rows = [(1, 1, "user", "hi"), (1, 2, None, None), (2, 1, "user", "hi"), (2, 2, "user", "hi")]
    df = spark.createDataFrame(rows, TURNS)
    got = {(r.conv_id, r.depth, r.role, r.text) for r in prefix_trie.with_text(prefix_trie.prefix_trie(df), df).collect()}
    assert got == {(1, 0, None, None), (1, 1, "user", "hi"), (1, 2, "", ""), (2, 2, "user", "hi")}
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_only_prefixes_that_may_be_shared_are_kept(spark):
    rows = conversations()
    paths = prefix_trie.prefixes(prefix_trie.digested(spark.createDataFrame(rows, TURNS)))
    seen = prefix_trie.screened(paths).groupBy("kept").count().collect()
    counts = {r["kept"]: r["count"] for r in seen}
    convs = rebuilt(rows)
    times = collections.Counter(tuple(s[:d]) for s in convs.values() for d in range(len(s) + 1))
    needed = sum(d == 0 or times[tuple(s[:d])] > 1 for s in convs.values() if len(s) < 100 for d in range(len(s))) + 2401 + 2400
    assert needed <= counts[True] <= needed + 20 and counts[False] > 0


def placed(key, leaves, level=""):
    """The walk down the tree for one key."""
    def draw(name, weights):
        def at(n):
            bits = int(hashlib.md5(f"{name}{n}:{key}".encode()).hexdigest()[:13], 16)
            return -math.log((bits + 0.5) / 16 ** 13) / weights[n], n
        return min(map(at, weights))[1]
    weights = collections.defaultdict(float)
    for leaf in leaves:
        weights[("region", leaf.region)] += leaf.weight
        weights[("rack", leaf.rack)] += leaf.weight
    region = draw("region", {leaf.region: weights[("region", leaf.region)] for leaf in leaves})
    rack = draw("rack", {leaf.rack: weights[("rack", leaf.rack)] for leaf in leaves if leaf.region == region})
    return region, rack, draw("shard", {leaf.shard: leaf.weight for leaf in leaves if leaf.rack == rack})


def test_shards_equal_a_plain_walk(spark):
    rows = cases.odd_rows()
    leaves = [sharding.Leaf(0, 0, 0, 2.0), sharding.Leaf(0, 0, 1, 1.0), sharding.Leaf(0, 1, 2, 1.0), sharding.Leaf(1, 2, 3, 4.0)]
    got = sharding.assign(cases.table(spark, rows), leaves, leaves + [sharding.Leaf(2, 3, 4, 1.0)]).collect()
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), *placed("" if r[0] is None else r[0], leaves),
                                placed("" if r[0] is None else r[0], leaves + [sharding.Leaf(2, 3, 4, 1.0)])[2]) for r in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32, r.region, r.rack, r.shard, r.grown_shard) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_movement_stays_in_the_subtree_whose_weights_change(spark):
    leaves = [sharding.Leaf(r, r * 2 + k, (r * 2 + k) * 2 + s, 1.0 + s) for r in range(2) for k in range(2) for s in range(2)]
    # one shard heavier, its rack-mate lighter by as much: the rack's weight is the same, so only these two exchange rows
    changed = [leaf._replace(weight={0: 2.0, 1: 1.0}.get(leaf.shard, leaf.weight)) for leaf in leaves]
    rows = sharding.descend(spark.range(20_000), F.col("id"), leaves)
    rows = sharding.descend(rows, F.col("id"), changed, "new_").select("shard", "new_shard")
    moves = {(r["shard"], r["new_shard"]): r["rows"] for r in sharding.moved(rows, "shard", "new_shard").collect()}
    assert set(moves) == {(1, 0)} and 400 < moves[(1, 0)] < 2500
    counts = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}
    for leaf in leaves:
        assert abs(counts[leaf.shard] / 20_000 - leaf.weight / 12) < 0.01
    grown = sharding.descend(sharding.descend(spark.range(20_000), F.col("id"), sharding.even_tree(8)), F.col("id"), sharding.even_tree(9), "new_")
    into = {r["new_shard"]: r["rows"] for r in sharding.moved(grown.select("shard", "new_shard"), "shard", "new_shard").collect()}
    assert set(into) == {8}


def test_bad_trees_and_empty_table(spark):
    for leaves in ([], [sharding.Leaf(0, 0, 0, 0.0)], [sharding.Leaf(0, 0, 0), sharding.Leaf(1, 0, 1)], [sharding.Leaf(0, 0, 0), sharding.Leaf(0, 1, 0)]):
        with pytest.raises(ValueError):
            sharding.descend(spark.range(1), F.col("id"), leaves)
    assert sharding.assign(cases.table(spark, []), sharding.even_tree(8)).count() == 0


def test_shards_as_files(spark, tmp_path):
    docs = cases.table(spark)
    sharding.write_shards(docs, sharding.even_tree(8), str(tmp_path / "shards"), files=2)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert cases.plain(back.select("row.*")) == cases.plain(docs)
    assert {tuple(r) for r in back.select("row.doc_id", "region", "rack", "shard").collect()} == {
        (r.doc_id, *placed("" if r.doc_id is None else r.doc_id, sharding.even_tree(8))) for r in docs.collect()}


# every sign that is no part of a term, by the contract
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split(text):
    return [t for t in re.split(GAP, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if t]


def ranked(docs, items, k=10):
    bags = [(d, collections.Counter(split(text))) for d, text in docs]
    n_docs = sum(bool(bag) for _, bag in bags)
    length = sum(bag.total() for _, bag in bags)
    out = []
    for item, text in items:
        query, scores = collections.Counter(split(text)), []
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in bag for _, bag in bags) + 1))) for t in query}
        for d, bag in bags:
            if bag:
                m = 25 + 75 * bag.total() * n_docs // length
                score = sum(q * weight[t] * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * m)) for t, q in query.items() if t in bag)
                if score > 0:
                    scores.append((-score, d is None, d))
        out += [(item, rank, d, -score) for rank, (score, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed=2, n=900):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 3))) for _ in range(300)] + ["Été", "ΑΣ", "İx", "x1"]
    def text(size):
        return rnd.choice([" ", "-", "\n"]).join(words[min(int(rnd.expovariate(0.02)), len(words) - 1)] for _ in range(size))
    docs = [(i, text(rnd.randint(1, 60))) for i in range(n)]
    copy = docs[7][1]
    docs += [(5000 - i, copy) for i in range(200)] + [(r[0], r[1]) for r in cases.odd_rows()] + [(9000, " ".join(words * 40)), (9001, "...")]
    items = [(i, " ".join(docs[rnd.randrange(n)][1].split()[:12])) for i in range(30)] + [(50, copy), (50, "été ΑΣ ΑΣ a a"), (51, None), (52, "!?"), (53, "zzzz"),
             (None, "x1 b")]
    return docs, items


@pytest.mark.parametrize("block", [lexical.BLOCK_TERMS, 40])
def test_search_equals_scoring_every_document(spark, block):
    docs, items = corpus()
    got = lexical.search(cases.table(spark, [(d, t, None, None, None) for d, t in docs]), spark.createDataFrame(items, "item_id long, text string"),
                         block_terms=block).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == ranked(docs, items)


def test_most_pairs_of_nodes_are_left_out(spark):
    """Clustered documents: the trees reach the answers with few exact comparisons."""
    rnd = random.Random(4)
    topics = [[f"t{i}w{j}" for j in range(30)] for i in range(64)]
    texts = [" ".join(rnd.choices(topics[i % 64], k=20) + rnd.choices(["a", "b", "c"], k=10)) for i in range(6400)]
    vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t.split()}))}
    items = lexical.Items(list(range(64)), list(vocabulary), [collections.Counter(vocabulary[w] for w in rnd.choices(topics[i], k=8) + ["a"]) for i in range(64)])
    df = collections.Counter(vocabulary[w] for t in texts for w in set(t.split()))
    weights = np.array([math.floor(1000 * math.log((2 * 6400 + 2) / (2 * df[i] + 1))) for i in range(len(vocabulary))])
    whole = lexical.Corpus(6400, 6400 * 30, weights)
    hierarchy, counts = lexical.item_tree(items, weights)
    state = lexical.Search(hierarchy, counts, whole, 10, np.zeros(64, np.int64))
    scored = []
    exact = state._score
    state._score = lambda leaf, vectors, *rest: (scored.append(len(vectors)), exact(leaf, vectors, *rest))
    bags = [sorted(collections.Counter(vocabulary[w] for w in t.split()).items()) for t in texts]
    offsets = np.cumsum([0] + [len(b) for b in bags])
    state.add(np.arange(6400), np.full(6400, 30), offsets, np.array([t for b in bags for t, _ in b]), np.array([n for b in bags for _, n in b]))
    leaves = -(-64 // lexical.ITEM_LEAF)
    assert sum(scored) < 0.5 * leaves * 6400
    for i, query in enumerate(items.counts):
        best = sorted((-sum(q * weights[t] * (10 ** 9 * n // (1000 * n + 800)) for t, n in bag for q in [query.get(t, 0)]), d) for d, bag in enumerate(bags))[:10]
        assert [(-int(s), int(d)) for s, d in zip(state.scores[i], state.ids[i])] == [(int(s), d) for s, d in best]


def test_terms_across_pieces():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab é.Z-\n") for _ in range(rnd.randint(0, 40))) for _ in range(60)] + ["a" * 100, ". " * 50, "é" * 30]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0] + [len(t.encode()) for t in texts])
    for size in (1, 3, 16, 1000):
        got = [[] for _ in texts]
        for text, part, starts, ends in lexical.pieces(raw, bounds, size):
            for i, a, b in zip(text, starts, ends):
                got[i].append(bytes(part[a:b]).decode())
        assert got == [[x for x in re.split(GAP, t) if x] for t in texts]


def test_hashes_tell_long_terms_apart():
    a = b"x" * 65_536 + b"ab" * 40_000
    b = b"ab" * 40_000 + b"x" * 65_536
    raw = np.frombuffer(a + b + a, np.uint8)
    starts = np.array([0, len(a), 2 * len(a)])
    h = lexical.hash_terms(raw, starts, starts + len(a))
    assert h[0] == h[2] != h[1]


def test_search_in_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(cases.table(spark, []), items).count() == 0
    assert lexical.search(cases.table(spark), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_checksums_in_sql():
    import duckdb
    for text in ("", "a", "é😀" * 9):
        sql = f"WITH {queries._CRC_SQL} SELECT {queries.crc_sql('encode(?)')} FROM crc_table"
        assert duckdb.execute(sql, [text]).fetchone()[0] == zlib.crc32(text.encode())
