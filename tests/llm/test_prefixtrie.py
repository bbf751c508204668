import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from strata.llm import prefixtrie, queries

DDL = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x, key=lambda t: t[:2])] for c, x in own.items()}
    out = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + x[h:]
    return out


def brute(convs):
    """Every node of a plain trie of the whole sequences."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, x in convs.items():
        for d in range(len(x) + 1):
            members[tuple(x[:d])].append(c)
        ends[tuple(x)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], sha(ends[p]))
                   for p, m in members.items())


def made_up(seed, n, deep):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 400), n):
        for i in range(rng.choice([1, 2, 5, deep])):
            rows.append((c, None if rng.random() < 0.02 else i, rng.choice(["user", None]), rng.choice(["", "é", "a long text", None])))
    return rows


@pytest.mark.parametrize("block, batches, deep", [(4, 3, 40), (1024, 2, 12), (3, 1, 9)])
def test_nodes_equal_brute_force(spark, monkeypatch, block, batches, deep):
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    rows = made_up(batches, 150, deep)
    seen = {}
    rows = [r for r in rows if seen.setdefault(r[:2], r) is r]  # one turn of each number
    turns, convs = prefixtrie.numbered_turns(spark.createDataFrame(rows, DDL))
    got = prefixtrie.prefix_trie(prefixtrie.grafted(turns, convs), convs, batches)
    assert got.columns == COLUMNS
    assert Counter(map(tuple, got.collect())) == brute(rebuilt(rows))


def test_exits_are_found_by_the_search(spark, monkeypatch):
    """Every block leaves a trie of other conversations exactly where a comparison with all of them says."""
    monkeypatch.setattr(prefixtrie, "BLOCK", 8)
    rng = random.Random(5)
    convs = {c: [("u", rng.choice("ab")) for _ in range(rng.randrange(1, 30))] for c in range(120)}
    rows = [(c, i, *t) for c, x in convs.items() for i, t in enumerate(x)]
    turns, _ = prefixtrie.numbered_turns(spark.createDataFrame(rows, DDL))
    paths = prefixtrie._paths(turns)
    edges = prefixtrie.build(paths.where("conv < 40"), 1)
    found = prefixtrie.exits(edges, paths.where("conv >= 40"), 8).select("conv", "top.d", "exit").collect()
    known = {tuple(x[:d]) for c, x in convs.items() if c < 40 for d in range(len(x) + 1)}
    assert found
    for conv, top, at in found:
        deepest = max(d for d in range(len(convs[conv]) + 1) if tuple(convs[conv][:d]) in known)
        assert at == (min(max(deepest, top), top + 8) if deepest >= top else top)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    got = queries.QUERIES["op13_conversation_trie"](spark, "/root/testdata/sf0.01")
    assert Counter(map(tuple, got.collect())) == brute(rebuilt(rows))


def test_edges(spark):
    none = spark.createDataFrame([], DDL)
    trie = lambda df: prefixtrie.prefix_trie(*prefixtrie.numbered_turns(df))
    assert trie(none).count() == 0
    long_text = "word " * 50_000
    rows = [(7, 0, "user", long_text), (7, 0, "user", long_text), (7, 0, "user", "tie"), (8, None, None, None), (8, 1, "user", "x"),
            (9, None, "", ""), (9, 5, "user", "x"), (None, 0, "user", "lost"), (-3, 0, "user", "x"), (10, 0, None, "")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], DDL + ", n int, node string")
    got = Counter(map(tuple, trie(df).collect()))
    ties = [got & brute({7: x, 8: [("", ""), ("user", "x")], 9: [("", ""), ("user", "x")], -3: [("user", "x")], 10: [("", "")]})
            for a, b in [(("user", long_text), ("user", "tie"))] for x in ([a, a, b], [b, a, a])]
    assert got in ties  # repeated turns stay; the order of two turns of one number is fixed by hashes
