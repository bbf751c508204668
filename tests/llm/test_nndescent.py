import numpy as np
import pytest

from strata.llm import nndescent


def brute(rows, threshold):
    n, root = {}, {}
    usable = [(i, l, np.array(v, float)) for i, v, l in rows if i is not None and l is not None and v
              and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids = [i for i, *_ in usable]
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    count = {i: 0 for i in ids}
    for k, (i, l, v) in enumerate(usable):
        for j, m, w in usable[:k]:
            if l == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold:
                count[i] += 1
                count[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (count[i], find(i)) for i in ids}


@pytest.fixture(scope="module")
def rows():
    rng, out = np.random.default_rng(3), []
    for group, size in enumerate([1] * 150 + [2] * 20 + [3] * 10 + [40, 12]):  # the last two saturate the lists
        centre = rng.standard_normal(24)
        for _ in range(size):
            v = centre + rng.standard_normal(24) * (0.12 if size < 12 else 0.2)
            out.append((len(out), [float(x) for x in v.astype(np.float32)], group % 3))
    return out


def test_links_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, id string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nndescent.near_duplicates(df, width=4, leaf=16).collect()}
    want = brute(rows, 0.93)
    assert got == want and max(n for n, _ in want.values()) > 4


def test_links_between_saturated_clusters(spark):
    """Pairs of tight clusters, all larger than the lists, linked to each other at about 0.94."""
    rng, out = np.random.default_rng(5), []
    for _ in range(12):
        one, other = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        for centre in (one, 0.94 * one + np.sqrt(1 - 0.94 ** 2) * other):
            for _ in range(20):
                v = centre + rng.standard_normal(32) * 0.004
                out.append((len(out), [float(x) for x in v.astype(np.float32)], 0))
    df = spark.createDataFrame(out, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nndescent.near_duplicates(df).collect()}
    want = brute(out, 0.93)
    assert got == want and len({c for _, c in want.values()}) == 12


def test_enlarged_lists_show_the_links_that_saturated_ones_hide(spark, monkeypatch):
    """The same kind of clusters by the lists alone: the search across groups finds nothing."""
    rng, out = np.random.default_rng(9), []
    for _ in range(6):
        one, other = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        for centre in (one, 0.94 * one + np.sqrt(1 - 0.94 ** 2) * other):
            for _ in range(14):
                out.append((len(out), [float(x) for x in centre + rng.standard_normal(32) * 0.004], 0))
    df = spark.createDataFrame(out, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(nndescent, "links_across", lambda classes, *a: classes.select("id", "id").toDF("a", "b").limit(0))
    monkeypatch.setattr(nndescent, "audit", lambda classes, *a: (1.0, classes.select("id", "id").toDF("a", "b").limit(0)))
    got = {r.vec_id: (r.n_links, r.component_id) for r in nndescent.near_duplicates(df, width=4, rounds=6).collect()}
    assert got == brute(out, 0.93)


def test_cosines_of_doubles(spark):
    """Vectors whose cosine is on different sides of the threshold as floats and as doubles."""
    rng, out = np.random.default_rng(4), []
    while len(out) < 40:
        a = rng.standard_normal(8)
        b = rng.standard_normal(8)
        b -= a * (a @ b) / (a @ a)
        c = 0.93 + float(rng.choice([-1, 1])) * 10 ** rng.uniform(-12, -9)
        v = c * a / np.linalg.norm(a) + np.sqrt(1 - c * c) * b / np.linalg.norm(b)
        cosine = lambda x, y: x @ y / np.linalg.norm(x) / np.linalg.norm(y)
        as_float = cosine(*(np.float32(x).astype(float) for x in (a, v)))
        if (cosine(a, v) >= 0.93) != (as_float >= 0.93) and abs(cosine(a, v) - 0.93) > 1e-13:
            out += [(len(out), a.tolist(), len(out)), (len(out) + 1, v.tolist(), len(out))]
    df = spark.createDataFrame(out, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nndescent.near_duplicates(df).collect()}
    assert got == brute(out, 0.93)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [2.0, 0.0], 0), (4, [1.0, 0.0], 1), (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0),
           (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (11, [1.0, 0.0], None), (12, [1.0, 0.0, 0.0], 0),
           (None, [1.0, 0.0], 0), (13, [-0.0, 1.0], 0), (14, [0.0, 1.0], 0)]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in nndescent.near_duplicates(df).collect()}
    want = brute(odd, 0.93)
    assert len(got) == len(odd)
    for i, r in got.items():
        n, c = want.get(i, (0, i))
        assert (r.n_links, r.component_id, r.kept) == (n, c, i == c), i
    assert nndescent.near_duplicates(df.limit(0)).count() == 0
