import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from strata.llm import queries, runs


def brute(words, min_length=6, repeats=4):
    """All runs by their definition: maximal stretches of every period, smallest period only."""
    out, n = [], len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= max(min_length, repeats * q):
                part = words[start:end]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((start, end - start, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def digest(doc_id, text, altered):
    words = [w.decode() for w in (text or "").encode().split()]
    if altered and doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("min_length, repeats", [(6, 4), (2, 2), (7, 3), (12, 4)])
def test_runs_equal_brute_force(min_length, repeats):
    rng = random.Random(repeats)
    docs = [[], [0], [0] * 5, [0] * 6, [0] * 300, [0, 1] * 4, [0, 1, 0, 1, 0, 1, 0], [0, 1, 1, 1, 1, 1, 1] * 9 + [0]]
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a  # Fibonacci words hold many runs
    docs.append(b)
    for _ in range(400):
        unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 12))]
        d = [rng.randrange(3) for _ in range(rng.randrange(20))] + unit * rng.randrange(1, 12) + unit[:rng.randrange(len(unit))]
        docs.append(d + [rng.randrange(2) for _ in range(rng.randrange(25))])
    rng.shuffle(docs)
    lengths = np.array([len(d) for d in docs])
    found = runs.find_runs(np.array([w for d in docs for w in d], np.int64), lengths, min_length, repeats)
    expected = [(i, *r) for i, d in enumerate(docs) for r in brute(d, min_length, repeats)]
    assert expected and [tuple(r) for r in found.tolist()] == expected


def test_query_equals_brute_force(spark, tmp_path, edge_docs):
    text = " ".join(f"w{i % 50}" for i in range(700))
    rows = [(i, [text, "a b " * 40, " ".join(f"x{j}" for j in range(i)), "say it again\n" * 9 + "end", None, ""][i % 6]) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(digest(i, t, True) for i, t in rows)


def test_edges(spark, edge_docs, no_docs):
    got = runs.run_digests(runs.periodic_runs(edge_docs)).collect()
    rows = edge_docs.select("doc_id", "text").collect()
    few = lambda r: r[0] != 5  # noqa: E731  the very long text, below
    assert Counter(filter(few, map(tuple, got))) == Counter(digest(r.doc_id, r.text, False) for r in rows if few(r))
    assert [(r.n_runs, r.start, r.length, r.period) for r in got if r.doc_id == 5] == [(1, 0, 120_000, 2 * 977 * 13)]
    assert runs.run_digests(runs.periodic_runs(no_docs)).count() == 0


def test_a_long_run_takes_time_in_proportion():
    codes = np.zeros(200_000, np.int64)
    assert runs.find_runs(codes, np.array([len(codes)]), 6, 4).tolist() == [[0, 0, 200_000, 1]]
