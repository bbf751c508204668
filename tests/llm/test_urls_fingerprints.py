import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import fingerprints, urls
from strata.llm.queries import URL_RULES


def by_hand(url):
    u = url or ""
    if "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def test_urls_rules_and_model(spark):
    rnd, rows = random.Random(1), []
    for i in range(600):
        good = i % 2 == 0
        slug = "".join(rnd.choice("aeiou" if good else "xzqkw") for _ in range(12))
        host = rnd.choice(["a.org", "WWW.b.example.ORG", "c.com", "d.net", "example.org", "notorg", "org"])
        path = rnd.choice(["/fr/", "/de/", "/es/", "/en/1", "/en/2"])
        if host in ("a.org", "org"):
            path = "/ok/"
        rows.append((i, f"https://{host}{path}{slug}{rnd.choice(['', '?q=1', '#top', '?a=/x/'])}", host))
    odd = [None, "", "no scheme", "http://", "http://X.org", "http://x.org?y", "a://b://c/d", "http://é.com/fr/ü", "http://x.com/fr\n/z"]
    rows += [(1000 + i, u, "odd") for i, u in enumerate(odd)] + [(None, "http://q.net/aeiou", "odd"), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = urls.judge_urls(pages, URL_RULES, sample=500).collect()
    assert len(got) == len(rows)
    assert {(r.page_id, r.host, r.path) for r in got} == {(i, *by_hand(u)) for i, u, _ in rows}
    verdicts = {x.name: x.verdict for x in URL_RULES}
    for r in got:
        fits = [x for x in URL_RULES if (r.host == x.host or r.host.endswith("." + x.host)) and r.path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.name)).name if fits else None
        assert r.rule == best
        assert r.verdict in ("allow", "block") and (best is None or r.verdict == verdicts[best])
    assert urls.judge_urls(pages.limit(0), URL_RULES).count() == 0
    alone = urls.judge_urls(pages.where("page_id >= 1003"), []).collect()  # no rules, so no model
    assert {r.verdict for r in alone} == {"allow"} and {r.rule for r in alone} == {None}


def test_likelihood_ratio_separates_held_out_urls():
    rnd = random.Random(2)
    make = lambda letters: f"http://{''.join(rnd.choice(letters) for _ in range(6))}.net/{''.join(rnd.choice(letters) for _ in range(9))}"
    good, bad = [make("abcdef") for _ in range(400)], [make("defghi") for _ in range(400)]
    ratio = urls.Ratio([u.encode() for u in good[:300]], [u.encode() for u in bad[:300]], 4)
    at = urls.calibrate([ratio.score(u) for u in good[:300]], [ratio.score(u) for u in bad[:300]])
    assert sum(ratio.score(u) >= at for u in good[300:]) > 90 and sum(ratio.score(u) < at for u in bad[300:]) > 90
    model = urls.Markov([b"abab", b"abc"], 2)
    for context in (b"", b"a", b"ab", b"zz"):
        assert abs(sum(model.probability(context + bytes([c])) for c in range(256)) - 1) < 1e-9
    assert urls.calibrate([], [1.0]) == 0.0


def fitted_by_hand(labelled, order=4, held_out=5):
    """The models of all labelled URLs (Rows url, verdict, in the order of their hash) and the threshold."""
    own = {v: [r.url for r in labelled if r.verdict == v] for v in ("allow", "block")}
    fit = {v: [u for i, u in enumerate(us) if i % held_out or len(us) <= held_out] for v, us in own.items()}
    held = {v: [u for i, u in enumerate(us) if i % held_out == 0 or len(us) <= held_out] for v, us in own.items()}
    ratio = urls.Ratio(*([u.lower().encode() for u in fit[v]] for v in ("allow", "block")), order)
    return ratio, urls.calibrate(*([ratio.score(u) for u in held[v]] for v in ("allow", "block")))


def judged(spark, texts):
    """(rows by page_id, those that rules decide in the order of their hash) over numbered URLs."""
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    rows = {r.page_id: r for r in urls.judge_urls(pages, URL_RULES).collect()}
    order = pages.select("page_id", "url", F.xxhash64("url").alias("h")).dropDuplicates(["url"]).orderBy("h", "url").collect()
    verdicts = {x.name: x.verdict for x in URL_RULES}
    return rows, [r for r in (Labelled(x.url, verdicts.get(rows[x.page_id].rule)) for x in order) if r.verdict]


class Labelled:
    def __init__(self, url, verdict):
        self.url, self.verdict = url, verdict


def agrees(rows, labelled, texts):
    ratio, at = fitted_by_hand(labelled)
    for i, u in enumerate(texts):
        assert rows[i].score == pytest.approx(ratio.score(u), abs=1e-9)
        if rows[i].rule is None:
            assert rows[i].verdict == ("allow" if ratio.score(u) >= at else "block")


def test_every_labelled_url_is_learned_from(spark):
    rnd = random.Random(5)
    word = lambda letters, n=8: "".join(rnd.choice(letters) for _ in range(n))
    texts = [f"http://a.org/{word('abcdefgh')}" for _ in range(20_300)] + [f"https://b.com/de/{word('efghxyz')}" for _ in range(60)]
    texts += [f"http://c.net/{word('abefxyz')}" for _ in range(40)] + ["http://É.net/ü", "", None, texts[0]]
    rows, labelled = judged(spark, texts)
    assert sum(r.verdict == "allow" for r in labelled) > 20_000
    agrees(rows, labelled, texts)


def test_long_urls_are_learned_from(spark, monkeypatch):
    good = [f"http://a.org/{'abc' * 5}{i}" for i in range(12)]
    bad = [f"http://b.com/de/{'xyzw' * 1200}{i}" for i in range(12)]  # all blocked ones are longer than 4096 bytes
    texts = [*good, *bad, "http://c.net/abcabcabc", "http://c.net/xyzwxyzwxyzw", "q://"]
    rows, labelled = judged(spark, texts)
    assert rows[24].verdict == "allow" and rows[25].verdict == "block"
    agrees(rows, labelled, texts)
    monkeypatch.setattr(urls, "MOST_ENTRIES", 30)  # the model in many parts
    again, _ = judged(spark, texts)
    assert all(again[i].score == pytest.approx(rows[i].score, abs=1e-9) and again[i].verdict == rows[i].verdict for i in rows)


def test_places_of_long_texts_are_taken_in_runs():
    texts = [b"", b"abcdefg", b"h", b"", b"ijklmnopq" * 9]
    whole = [np.concatenate(x) for x in zip(*urls.gram_codes(texts, 3))]
    runs = [np.concatenate(x) for x in zip(*urls.gram_codes(texts, 3, 5))]
    assert all((a == b).all() for a, b in zip(whole, runs))
    assert [int(c) for c in whole[1][:5]] == [int.from_bytes(b"\1" + g, "big") for g in (b"a", b"ab", b"abc", b"abcd", b"bcde")]


def test_threshold_over_many_ranges(spark):
    rnd = random.Random(3)
    for n in (1, 2, 300):
        rows = [(v, round(rnd.gauss(mean, 1), 1)) for v, mean in (("allow", 1), ("block", 0)) for _ in range(n)]
        want = urls.calibrate(*([s for v, s in rows if v == side] for side in ("allow", "block")))
        sides = lambda at: sum((s >= at) == (v == "allow") for v, s in rows)
        got = urls.best_threshold(spark.createDataFrame(rows, "verdict string, score double").repartition(7))
        assert sides(got) == sides(want) and (n > 2 or got == want)
    assert urls.best_threshold(spark.createDataFrame([("allow", 1.0)], "verdict string, score double")) == 0.0


def test_fingerprints_of_edits(spark, edge_docs, no_docs):
    docs = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(docs.select("doc_id", "text").collect())
    texts = [r.text or "" for r in rows]
    for size in (100_000, 1 << 24):  # several key ranges, one range
        got = sorted(fingerprints.fingerprint_edits(docs, least_df=1, most_share=1.0, bucket_chars=size).collect(), key=lambda r: r.doc_id)
        assert [r.doc_id for r in got] == [r.doc_id for r in rows]
        prints = {}
        for i, r in enumerate(got):
            half = len(texts[i]) // 2
            edited = texts[i][:len(texts[i]) - half] + texts[(i + 1) % len(texts)][:half]
            assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.near_next == fingerprints.likeness(r.fingerprint, got[(i + 1) % len(got)].fingerprint)
            assert r.near_edited == fingerprints.likeness(r.fingerprint, r.edited_fingerprint)
            assert prints.setdefault(texts[i], r.fingerprint) == r.fingerprint
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert fingerprints.fingerprint_edits(no_docs).count() == 0
    assert fingerprints.fingerprint_edits(edge_docs).count() == edge_docs.count()  # repeated and NULL keys
    one = fingerprints.fingerprint_edits(docs.where("doc_id = 0"), least_df=1).first()
    assert one.near_next == 1.0


def test_fingerprint_tells_edits_from_other_texts(spark):
    from strata.llm.common import table
    got = fingerprints.fingerprint_edits(table(spark, "/root/testdata/sf0.01", "documents")).collect()
    assert sum(r.near_edited > r.near_next for r in got) > 0.85 * len(got)
    lexicon, _ = fingerprints.fit_lexicon(table(spark, "/root/testdata/sf0.01", "documents"), 2, 0.02)
    assert lexicon.fingerprint("b a a") == lexicon.fingerprint("A, b.")
