"""Recall of the line candidates against edit similarity alone, by line length and edits.

Run as a script for the table of the README."""

import random

import pandas as pd

from strata.llm import lines

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def edited(rnd, line, edits):
    """``edits`` letters put in, taken out or changed at places of their own."""
    s = list(line)
    for at in sorted(rnd.sample(range(len(s)), edits), reverse=True):
        kind = rnd.randrange(4)
        if kind == 0:
            s[at:at] = rnd.choice(LETTERS)
        elif kind == 1 and s[at] != " ":
            del s[at]
        else:
            s[at] = rnd.choice(LETTERS)
    return "".join(s)


def found_share(spark, words, edits, n=400, seed=1):
    """Share of the pairs (line, edited line) that are edit-alike at 90 % and share a key."""
    rnd = random.Random(f"{seed} {words} {edits}")
    stock = ["".join(rnd.choice(LETTERS) for _ in range(rnd.choice([2, 3, 4, 5, 6, 7, 8, 9, 10]))) for _ in range(20_000)]
    pairs = []
    for _ in range(n):
        line = " ".join(rnd.choices(stock, k=words))
        k = edits if edits >= 1 else max(1, int(edits * len(line)))
        other = edited(rnd, line, k)
        a, b = lines.normalised([line, other])
        if a != b and lines.similar(a, b, 90):
            pairs.append((line, other))
    if not pairs:
        return None
    rows = [x for p in pairs for x in p]
    n_words, _, _, blocks, letters, half = lines.describe_lines(rows)
    pdf = pd.DataFrame(dict(zip(["i", *lines.SIGNATURE], [range(len(rows)), n_words, letters, *blocks.T, *half.T])))
    got = {r.i: set(r["keys"]) for r in spark.createDataFrame(pdf).select("i", lines.line_keys().alias("keys")).collect()}
    return sum(bool(got[2 * i] & got[2 * i + 1]) for i in range(len(pairs))) / len(pairs)


if __name__ == "__main__":
    from strata.session import get_session
    session = get_session("local[4]", 4)
    for words in (3, 4, 6, 8, 10, 12, 16, 20, 24, 30, 40, 60, 80, 160):
        print(words, [x if x is None else round(x, 3) for x in (found_share(session, words, e) for e in (1, 2, 3, 0.03, 0.05, 0.08))], flush=True)
