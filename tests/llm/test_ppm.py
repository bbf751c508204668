import collections
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from strata.llm import ppm


def brute(train, texts, order):
    """Textbook PPM (escape C, exclusion) over byte lists with a start and an end symbol."""
    seen = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for t in train:
        s = [257] * order + list(t) + [256]
        for i in range(order, len(s)):
            for k in range(order + 1):
                seen[k][tuple(s[i - k:i])][s[i]] += 1

    def probability(context, symbol):
        p, gone = 0.0, set()
        for k in range(order, -1, -1):
            c = seen[k].get(tuple(context[len(context) - k:]))
            c = {a: n for a, n in (c or {}).items() if a not in gone}
            if not c:
                continue
            total = sum(c.values()) + len(c)
            if symbol in c:
                return p + math.log10(c[symbol] / total)
            p += math.log10(len(c) / total)
            gone |= set(c)
        return p + math.log10(1 / (257 - len(gone)))

    out = []
    for t in texts:
        s = [257] * order + list(t) + [256]
        out.append(sum(probability(s[i - order:i], s[i]) for i in range(order, len(s))))
    return out, probability


def test_scores_equal_brute_force(spark, edge_docs):
    docs = edge_docs.where(F.coalesce(F.length("text"), F.lit(0)) < 1000)
    rows = docs.select("doc_id", "text").collect()
    for order, bundle in ((2, 40), (4, 10_000)):
        got = ppm.score_documents(docs, order=order, bundle_bytes=bundle).collect()
        held = [zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 7 == 2 for r in rows]
        texts = [(r.text or "").encode().lower() for r in rows]
        scores, _ = brute([t for t, h in zip(texts, held) if not h], texts, order)
        counts = collections.Counter(w for t, h in zip(texts, held) if not h for w in t.split())
        ends = held.count(False)
        total, kinds = sum(counts.values()) + ends, len(counts) + 1
        expected = collections.Counter()
        for r, h, t, s in zip(rows, held, texts, scores):
            tokens = [counts[w] for w in t.split()] + [ends]
            base = sum(math.log10((c + 1) / (total + kinds + 1)) for c in tokens)
            expected[(r.doc_id, h, len(tokens), sum(c > 0 for c in tokens), total, round(base, 6), round(s, 3))] += 1
        assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6),
                                    round(r.score, 3)) for r in got) == expected


def test_probabilities_of_the_next_symbol_sum_to_one():
    texts = [b"the cat", b"the bat sat", b"", b"thin"]
    grams, _ = ppm.grams_of(texts, 3)
    context = grams[5] >> ppm.BITS
    every = np.unique(np.concatenate([grams, (context << ppm.BITS) | np.arange(257)]))
    n = np.array([(grams == g).sum() for g in every])
    pairs, count = np.unique(ppm.low(grams, 1), return_counts=True)
    keys, logs = ppm.log_probabilities(every, n, 3, ppm.Shallow(pairs, count))
    own = keys >> ppm.BITS == context
    assert own.sum() == 257 and abs((10 ** logs[own]).sum() - 1) < 1e-9


def test_no_documents_and_no_training(spark, no_docs):
    assert ppm.score_documents(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.score_documents(docs, F.lit(True)).collect()}
    assert abs(got[1].score - 3 * math.log10(1 / 257)) < 1e-5 and got[1].train_tokens == 0
    assert abs(got[2].score - math.log10(1 / 257)) < 1e-6 and got[2].n_tokens == 1
