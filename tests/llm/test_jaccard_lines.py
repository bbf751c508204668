import hashlib
import random
import textwrap
import time

import numpy as np
import pytest

from line_recall import found_share

from strata.llm import jaccard, lines


def components(ids, linked):
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


@pytest.fixture(scope="module")
def copies(spark):
    """Families of copies with growing numbers of edits, chains and exact copies."""
    rnd, rows = random.Random(5), []
    for family in range(6):
        words = [f"w{rnd.randint(0, 60)}" for _ in range(60 + 30 * family)]
        for copy in range(14):
            w = list(words)
            for _ in range(copy // 3):
                w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 9999)}"
            rows.append((len(rows), " ".join(w)))
            if copy % 4 == 0:
                words = w  # the family drifts: a chain
    rows += [(len(rows) + i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9)))) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_near_groups_equal_brute_force(copies, width, percent):
    sets = {r.doc_id: shingles(r.text, width) for r in copies.collect()}
    links = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    expected = components(sorted(sets), links)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_groups(copies, width=width, percent=percent).collect()}
    assert got == {i: (len(sets[i]), expected[i]) for i in sets}
    assert len(set(expected.values())) < len(sets) - 20


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (1, 90)])
def test_near_groups_of_unequal_sizes_equal_brute_force(spark, width, percent):
    """Appended, truncated and inserted passages, with groups of exact copies."""
    rnd, texts = random.Random(11), []
    fresh = iter(range(10 ** 6))
    for family in range(12):
        n = rnd.choice([40, 150, 400, 900])
        words = [f"s{next(fresh)}" for _ in range(n)]
        texts += [words] * rnd.randint(1, 3)
        for share in (0.03, 0.08, 0.1, 0.11, 0.2, 0.24):
            k, at = max(1, int(share * n)), rnd.randrange(n)
            extra = [f"e{next(fresh)}" for _ in range(k)]
            edited = rnd.choice([words + extra, extra + words, words[:n - k], words[k:], words[:at] + extra + words[at:]])
            texts += [edited] * rnd.randint(1, 3)
    shared = [f"a{i}" for i in range(900 + width - 1)]
    texts += [shared, shared + [f"b{i}" for i in range(100)]]  # exactly 90 %, the extra shingles come first in the order
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = {i: shingles(" ".join(t), width) for i, t in enumerate(texts)}
    links = lambda a, b: 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    got = {r.doc_id: r.component_id for r in jaccard.near_groups(docs, width=width, percent=percent).collect()}
    assert got == components(sorted(sets), links)
    assert got[len(texts) - 1] == len(texts) - 2


def test_near_groups_edges(edge_docs, no_docs):
    got = jaccard.near_groups(edge_docs, width=3, percent=90).collect()
    rows = edge_docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)
    of = {r.doc_id: r.component_id for r in got}
    assert of[7] == 7 and of[8] == 7  # equal but for case
    assert of[0] == 0 and of[None] is None
    assert jaccard.near_groups(no_docs).count() == 0
    kept = jaccard.keep_one(edge_docs, width=3, percent=90)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.doc_id != 8)
    assert jaccard.keep_one(no_docs).count() == 0


def test_rows_without_a_key_or_with_a_repeated_one_are_documents_of_their_own(spark):
    say = lambda tag, n: [" ".join(f"{tag}{i}word{j}" for j in range(12)) for i in range(n)]
    a, b, c, d = say("ant", 3), say("bee", 3), say("cat", 4), say("dog", 1)
    texts = [(None, [*a, b[0]]), (None, [b[0], *c]), (None, [a[0], d[0]]), (7, [d[0]]), (7, [*b, c[3]]), (3, [b[1], c[2], a[2]]),
             (None, a), (None, a)]
    docs = spark.createDataFrame([(k, "\n".join(t), i) for i, (k, t) in enumerate(texts)], "doc_id long, text string, row int")
    got = {r.row: r for r in lines.dedup_lines(docs).collect()}
    assert len(got) == len(texts)
    held = sorted(x for r in got.values() for x in r.text.split("\n") if x)
    assert held == sorted({x for _, t in texts for x in t})  # every line stays once
    assert got[5].n_removed == 0 and got[3].text == d[0] and set(got[4].text.split("\n")) == {b[0], b[2], c[3]}

    long = lambda tag: " ".join(f"{tag}{j}" for j in range(60))
    texts = [(1, long("a")), (5, long("a")), (5, long("b")), (None, long("b")), (None, long("c")), (None, long("c") + " end"),
             (None, None), (None, "")]
    docs = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(texts)], "doc_id long, text string, row int")
    kept = {r.row for r in jaccard.keep_one(docs).collect()}
    assert kept - {4, 5} == {0, 2, 6, 7} and len(kept & {4, 5}) == 1


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rnd = random.Random(4)
    for _ in range(1500):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 9))) for _ in "ab")
        assert lines.edit_distance(a, b) == levenshtein(a, b)
        assert (lines.edit_distance(a, b, 3) <= 3) == (levenshtein(a, b) <= 3)
        for p in (60, 80, 90):
            assert lines.similar(a, b, p) == (levenshtein(a, b) <= (100 - p) * max(len(a), len(b)) // 100)


def line_groups(texts):
    """Smallest member of every normalised line's group by edit similarity of 90 % alone: all
    pairs but those that their numbers of each character already tell apart."""
    texts = sorted(set(texts))
    known = {c: i for i, c in enumerate(sorted(set("".join(texts))))}
    bags = np.zeros((len(texts), len(known) + 1), np.int32)
    for i, t in enumerate(texts):
        np.add.at(bags[i], [known[c] for c in t], 1)
    size, root = bags.sum(1), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i in range(len(texts)):
        apart = np.abs(bags[i + 1:] - bags[i])
        low = (apart.sum(1) + np.abs(size[i + 1:] - size[i])) // 2  # no fewer edits
        for j in (np.nonzero(low <= np.maximum(size[i + 1:], size[i]) // 10)[0] + i + 1).tolist():
            if find(i) != find(j) and lines.similar(texts[i], texts[j], 90):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {t: texts[find(i)] for i, t in enumerate(texts)}


def deduped(places):
    """(document, lines that stay) of (document, number, line) by the definition."""
    plain = lines.normalised([x for _, _, x in places])
    group, first, left = line_groups([t for t in plain if t]), {}, {}
    for (d, i, x), t in sorted(zip(places, plain), key=lambda z: z[0][:2]):
        left.setdefault(d, [])
        if not t or first.setdefault(group[t], (d, i)) == (d, i):
            left[d].append(x)
    return left


@pytest.mark.parametrize("words", [3, 4, 6, 10, 12, 20, 24, 40, 80, 160])
def test_one_edit_is_found_whatever_the_length(spark, words):
    assert found_share(spark, words, 1, n=300) >= 0.97
    if words >= 12:
        assert found_share(spark, words, 2, n=300) >= 0.85


def test_dedup_lines_equals_brute_force(spark):
    rnd, rows = random.Random(8), []
    stock = [" ".join(f"{rnd.choice('abcdefghij')}term{rnd.randint(0, 400)}" for _ in range(rnd.randint(3, 60))) for _ in range(80)]
    for d in range(100):
        own = []
        for _ in range(rnd.randint(0, 8)):
            line = rnd.choice(stock)
            if rnd.random() < 0.5:  # a small edit
                at = rnd.randrange(len(line))
                line = line[:at] + rnd.choice("xyz ") + line[at + 1:]
            own.append(rnd.choice([line, line.upper(), line + "!", ""]))
        rows.append((d, "\n".join(own)))
    rows.append((100, "\n".join(stock)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = [(d, i, x) for d, t in rows for i, x in enumerate(t.split("\n"))]
    expected = deduped(places)
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert {d: got[d].text for d in got} == {d: "\n".join(x) for d, x in expected.items()}
    assert all(got[d].n_lines - got[d].n_removed == len(x) for d, x in expected.items())


def test_lines_of_one_pattern_are_grouped_without_all_their_pairs(spark):
    """2000 classes share their keys; most are found alike by way of a few centres."""
    docs = spark.createDataFrame([(i, f"entry {i:04d} of the long alphabetical register of names") for i in range(2000)],
                                 "doc_id long, text string")
    assert lines.dedup_lines(docs, drop_emptied=True).count() == 1


def test_a_text_of_many_lines_takes_time_in_proportion(spark):
    text = "\n".join(" ".join(textwrap.wrap(hashlib.md5(str(i % 60_000).encode()).hexdigest(), 7)) for i in range(80_000))
    docs = spark.createDataFrame([(1, text), (2, "a short one")], "doc_id long, text string")
    begin = time.time()
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert (got[1].n_lines, got[1].n_removed, got[2].n_removed) == (80_000, 20_000, 0)
    assert time.time() - begin < 60


def test_dedup_lines_edges(edge_docs, no_docs):
    got = lines.dedup_lines(edge_docs).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == edge_docs.count() and set(got[0].asDict()) == set(edge_docs.columns)
    assert by_id[0].text == "The cat sat on the mat.\nAnother line here, with more words in it."
    assert (by_id[0].n_lines, by_id[0].n_removed) == (3, 1)
    assert by_id[1].text is None and by_id[1].n_lines == 0 and by_id[2].text == "" and by_id[3].text == "   \n\t "
    assert by_id[7].text == "" and by_id[8].text == ""
    left = lines.dedup_lines(edge_docs, counts=False, drop_emptied=True)
    assert left.columns == edge_docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert 7 not in ids and 8 not in ids and {1, 2, 3} <= set(ids)
    assert lines.dedup_lines(no_docs).count() == 0


def test_near_copies_that_do_not_link_make_no_rows_by_their_square(spark, monkeypatch):
    """Two edits of its own and one shared with one other: the rare shingles come first, and
    beyond them lies the text that the whole group has."""
    rnd, texts = random.Random(3), []
    base = [f"w{i}" for i in range(150)]
    for i in range(120):
        w = list(base)
        places = rnd.sample(range(5, 145, 5), 3)
        for place, new in zip(places, (f"a{i}", f"b{i}", None)):
            w[place] = new or w[place]
        partner = random.Random(1000 + i // 2).choice(range(7, 147, 5))
        w[partner] = f"p{i // 2}"
        texts.append((i, " ".join(w)))
    seen, real = [], jaccard.linked_groups

    def spy(postings, verify, **kw):
        a, b = (postings.select("key", *[postings[c].alias(f"{p}_{c}") for c in ("id", "n", "own", "place")]) for p in "ab")
        met = a.join(b, "key").where("a_id < b_id").where(kw["admissible"]("a", "b"))
        seen.append(met.count())
        return real(postings, verify, **kw)
    monkeypatch.setattr(jaccard, "linked_groups", spy)
    got = jaccard.near_groups(spark.createDataFrame(texts, "doc_id long, text string"), width=3, percent=90)
    assert {r.doc_id: r.component_id for r in got.collect()} == components(range(120), lambda a, b: (
        lambda x, y: 100 * len(x & y) >= 90 * len(x | y))(shingles(texts[a][1], 3), shingles(texts[b][1], 3)))
    assert seen[0] <= 5 * len(texts)


def test_the_sets_are_made_by_one_python_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "e f g h"), (None, "i j k l")], "doc_id long, text string")
    made = jaccard._sets(docs, 3, spark.createDataFrame([(1,)], "id long"))
    assert {r.id for r in made.collect()} == {jaccard.class_id(s) for s in jaccard.shingle_sets(["a b c d", "i j k l"], 3)}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_lines_whose_words_come_or_go_need_no_edit_distance(monkeypatch):
    rnd, pairs = random.Random(9), []
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 7)))
    for _ in range(400):
        x = [word() for _ in range(rnd.randint(4, 40))]
        y = list(x)
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randrange(len(y))
            y[at:at + rnd.randint(0, 1)] = [word() for _ in range(rnd.randint(0, 1))]
            y = y or [word()]
        pairs.append((x, y))
    for x, y in pairs:
        a, b = " ".join(x), " ".join(y)
        d = lines.edit_distance(a, b)
        assert d <= lines.word_edits(x, y, 10**6)
        assert lines.similar(a, b, 90) == (d <= max(len(a), len(b)) // 10)
    monkeypatch.setattr(lines, "edit_distance", None)
    words = [f"word{i}" for i in range(40)]
    assert lines.similar(" ".join(words), " ".join([*words[:9], "new", *words[9:30], *words[31:]]), 90)


def test_pairs_of_lines_are_compared_many_at_once(monkeypatch):
    """Pairs that no quick bound decides need no edit distance of their own."""
    rng = random.Random(7)
    left, right = [], []
    for n in (1, 20, 63, 64, 65, 127, 128, 129, 200, 300) * 40:
        a = [rng.choice("abcd é漢😀") for _ in range(n)]
        b = list(a)
        for _ in range(int(rng.choice((0, .02, .08, .1, .12, .2)) * n)):
            i = rng.randrange(len(b) + 1)
            b[i:i + rng.choice((0, 1))] = rng.choice(("", "x", "y"))
        pair = "".join(a), "".join(b)
        left.append(pair[rng.random() < 0.5])
        right.append(pair[left[-1] == pair[0]])
    expected = {p: [lines.similar(a, b, p) for a, b in zip(left, right)] for p in (90, 80)}
    assert 50 < sum(expected[90]) < 390
    monkeypatch.setattr(lines, "edit_distance", None)
    for p in (90, 80):
        assert lines.similar_pairs(left, right, p) == expected[p]
    assert lines.similar_pairs([], [], 90) == []


def test_few_or_long_pairs_are_compared_one_by_one():
    long = "word " * 500
    assert lines.similar_pairs([long, "abcdefghij", "", "ab cd ef gh ij"], [long + "x", "abcdefghiX", "abc", "cd ab gh ef"], 90) == [
        True, True, False, False]


def test_line_keys_are_made_outside_of_interpreted_expressions(spark):
    """One vectorised function makes the keys, with the words' limits and without repeats."""
    n = np.array([25, 19, 15, 11, 5, 5])
    letters = np.full(6, sum(20 << 10 * b for b in range(6)))
    blocks = [np.arange(6) % 4 + b for b in range(6)]
    half = [np.array([0, 0, 0, 7, 7, 0]), np.array([0, 0, 0, 8, 8, 0]), np.array([0, 0, 0, 7, 9, 0]), np.array([0, 0, 0, 8, 8, 0])]
    made = lines.keys_of(n, letters, blocks, half).to_pylist()
    keys = [set(x) for x in made]
    assert [len(x) for x in made] == [len(x) for x in keys] == [6, 6 + 15, 15, 15 + 20 + 2, 20 + 3, 20]
    assert keys[0] & keys[1] == set() and len(keys[0] & keys[4]) == 0 and len(keys[1] & keys[5]) == 0
    same = lines.keys_of(n[[0, 0]], letters[:2], [np.array([1, 1 + (b > 2)]) for b in range(6)], [np.zeros(2, int)] * 4).to_pylist()
    assert len(set(same[0]) & set(same[1])) == 3
    rows = [tuple(int(c[i]) for c in (n, letters, *blocks, *half)) for i in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in lines.SIGNATURE)).select(lines.line_keys().alias("keys"))
    assert "xxhash64" not in df._jdf.queryExecution().toString()
    assert sorted(map(sorted, (r.keys for r in df.collect()))) == sorted(map(sorted, made))
