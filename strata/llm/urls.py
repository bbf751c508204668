"""URL filter: domain/path rules first, then a character language-model ratio.

Two smoothed variable-order Markov models over the bytes of a URL (orders 0 to
``order``, each order interpolated with the next shorter one by Witten-Bell
weights) are fitted, one on accepted and one on rejected URLs. A URL's score is
the difference of the two log-likelihoods divided by its length; the verdict
compares it with a threshold calibrated on labelled URLs held out of the fit.

All labelled URLs are counted, as groups of Spark, and the models are tables: the
log-ratio of every gram seen and, for a gram that was not, the weight with which each of
its contexts hands over to the next shorter one. A gram is a number: 1 and then its bytes.
Tasks score with the part of the tables for some bytes before a place at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import drop, staged, text_slices

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: grams and contexts that a task holds at once (16 bytes each).
MOST_ENTRIES = 2_000_000


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, for paths that start with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else ''."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits (ties: the first in order of name), else NULL."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), [-ord(c) for c in r.name])):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name)).otherwise(out)
    return out


class Markov:
    """Witten-Bell interpolated byte model of a few URLs, in memory (``fit_ratio`` counts many);
    ``counts[k]`` maps a context of k bytes and the next byte to how often it was seen."""

    def __init__(self, urls: list[bytes], order: int):
        self.order = order
        self.counts: list[dict[bytes, int]] = [Counter() for _ in range(order + 1)]
        for u in urls:
            for k in range(order + 1):
                self.counts[k].update(u[i - k:i + 1] for i in range(k, len(u)))
        self.totals: list[dict[bytes, int]] = [Counter() for _ in self.counts]
        self.kinds: list[dict[bytes, int]] = [Counter() for _ in self.counts]
        for k, own in enumerate(self.counts):
            for gram, n in own.items():
                self.totals[k][gram[:-1]] += n
                self.kinds[k][gram[:-1]] += 1

    def probability(self, gram: bytes) -> float:
        """Of the last byte after the others (at most ``order``); never zero."""
        p = 1 / 256
        for k in range(len(gram)):
            own = gram[len(gram) - 1 - k:]
            kinds = self.kinds[k].get(own[:-1], 0)
            if kinds:
                p = (self.counts[k].get(own, 0) + kinds * p) / (self.totals[k][own[:-1]] + kinds)
        return p


class Ratio:
    """Length-normalised log-likelihood difference of two models, in nats a byte."""

    def __init__(self, accepted: list[bytes], rejected: list[bytes], order: int):
        self.order, self.models, self.known = order, (Markov(accepted, order), Markov(rejected, order)), {}

    def of_gram(self, gram: bytes) -> float:
        if gram not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[gram] = math.log(self.models[0].probability(gram)) - math.log(self.models[1].probability(gram))
        return self.known[gram]

    def score(self, url: str | None) -> float:
        u = (url or "").lower().encode()
        if not u:
            return 0.0
        k = self.order
        return sum(self.of_gram(u[max(0, i - k):i + 1]) for i in range(len(u))) / len(u)


def calibrate(accepted: list[float], rejected: list[float]) -> float:
    """Threshold with the best balanced accuracy over held-out scores (the middle
    of the gap between neighbouring scores; 0 if a side has none)."""
    if not accepted or not rejected:
        return 0.0
    marks = sorted([(s, 1 / len(accepted)) for s in accepted] + [(s, -1 / len(rejected)) for s in rejected])
    best, at, held = 0.0, marks[0][0], 0.0
    for i, (s, w) in enumerate(marks):  # everything up to s is rejected
        held -= w
        if (i + 1 == len(marks) or marks[i + 1][0] > s) and held > best:
            best, at = held, s + ((marks[i + 1][0] - s) / 2 if i + 1 < len(marks) else 1e-9)
    return at


def _lowered(urls: pa.Array) -> list[bytes]:
    return [(u or "").lower().encode() for u in urls.to_pylist()]


def gram_codes(urls: list[bytes], order: int, size: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the URL, code of the byte after up to ``order`` others) of every place, ``size``
    places at a time."""
    data = np.frombuffer(b"".join(urls), np.uint8)
    ends = np.cumsum([len(u) for u in urls])
    for begin in range(0, len(data), size):
        at = np.arange(begin, min(begin + size, len(data)))
        url = np.searchsorted(ends, at, side="right")
        place = at - np.concatenate([[0], ends])[url]
        code, known = np.zeros(len(at), np.int64), np.minimum(place, order)
        for k in range(order + 1):
            code[known >= k] |= data[at[known >= k] - k].astype(np.int64) << 8 * k
        yield url, code | 1 << 8 * (known + 1)


def _suffix(codes: np.ndarray, k: int) -> np.ndarray:
    """The last k + 1 bytes of grams."""
    return codes & (1 << 8 * (k + 1)) - 1 | 1 << 8 * (k + 1)


def _count_grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, column="url"):
            accepted = np.array([v == "allow" for v in b.column(1).to_pylist()])
            for url, codes in gram_codes(_lowered(b.column(0)), order):
                mine = accepted[url]
                for k in range(order + 1):
                    there = codes >= 1 << 8 * (k + 1)
                    grams, which = np.unique(_suffix(codes[there], k), return_inverse=True)
                    allow = np.bincount(which, mine[there], len(grams)).astype(np.int64)
                    both = np.bincount(which, minlength=len(grams))
                    yield pa.record_batch([pa.array(grams), pa.array(allow), pa.array(both - allow)], names=["code", "allow", "block"])

    return run


@dataclass
class RatioTable:
    """Log-ratios of the two models for places that come after one of the bytes ``after``
    (``first``: and for the first of a URL). ``grams`` and ``contexts`` are in order."""
    order: int
    after: np.ndarray
    first: bool
    grams: np.ndarray
    ratios: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray
    unseen: float

    def of_grams(self, codes: np.ndarray) -> np.ndarray:
        out, _ = self._found(self.grams, self.ratios, _suffix(codes, 0), self.unseen)
        for k in range(1, self.order + 1):
            long = np.flatnonzero(codes >= 1 << 8 * (k + 1))
            own = _suffix(codes[long], k)
            handed, _ = self._found(self.contexts, self.weights, own >> 8, 0.0)
            ratio, seen = self._found(self.grams, self.ratios, own, 0.0)
            out[long] = np.where(seen, ratio, out[long] + handed)
        return out

    @staticmethod
    def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.full(len(wanted), default), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        seen = keys[at] == wanted
        return np.where(seen, values[at], default), seen

    def sums(self, urls: list[bytes]) -> np.ndarray:
        out = np.zeros(len(urls))
        for url, codes in gram_codes(urls, self.order):
            own = np.where(codes < 1 << 16, self.first, self.after[codes >> 8 & 255])
            grams, which = np.unique(codes[own], return_inverse=True)
            out += np.bincount(url[own], self.of_grams(grams)[which], len(urls))
        return out


class FittedRatio:
    """The models as a staged table: is_gram, code, value (log-ratio of a gram, weight of a
    context), after (the byte that a place it is for comes after; -1: any)."""

    def __init__(self, entries: DataFrame, order: int):
        self.order, self.entries = order, entries
        sizes = dict(self.entries.groupBy("after").count().collect())  # at most 257
        self.unseen = next((r.value for r in self.entries.where("NOT is_gram AND code = 1").collect()), 0.0)
        self.groups: list[list[int]] = [[]]
        held = 0
        for byte in sorted(b for b in sizes if b >= 0):
            if held and held + sizes[byte] > MOST_ENTRIES:
                self.groups.append([])
                held = 0
            self.groups[-1].append(byte)
            held += sizes[byte]

    def _table(self, number: int) -> RatioTable:
        group, after = self.groups[number], np.zeros(256, bool)
        if len(self.groups) == 1:
            after[:] = True
        else:
            after[group] = True
            if number == 0:  # and the bytes that nothing was seen after
                after[[b for b in range(256) if not any(b in g for g in self.groups)]] = True
        rows = self.entries.where(F.col("after").isin(-1, *group)).select("is_gram", "code", "value").toArrow()
        is_gram, code, value = (rows.column(c).to_numpy() for c in ("is_gram", "code", "value"))
        by_code = np.argsort(code, kind="stable")
        is_gram, code, value = is_gram[by_code].astype(bool), code[by_code], value[by_code]
        return RatioTable(self.order, after, number == 0, code[is_gram], value[is_gram], code[~is_gram], value[~is_gram], self.unseen)

    def _part(self, number: int):
        shared = self.entries.sparkSession.sparkContext.broadcast(self._table(number))  # MOST_ENTRIES, or one byte's

        @F.arrow_udf("double")
        def part(urls: pa.Array) -> pa.Array:
            own = _lowered(urls)
            return pa.array(shared.value.sums(own) / np.maximum([len(u) for u in own], 1))

        return part

    def scored(self, rows: DataFrame, url: str = "url") -> DataFrame:
        """``rows`` and score, the difference of the log-likelihoods of ``url`` in nats a byte (0 without
        a byte). Tables too large for a task are taken one part after the other, and what the
        parts add up to is staged between them."""
        out = rows.withColumn("score", F.lit(0.0))
        for number in range(len(self.groups)):
            out = out.withColumn("score", F.col("score") + self._part(number)(url))
            if number + 1 < len(self.groups):
                out = staged(out, "url_scores")
        return out


def model_entries(counts: DataFrame, order: int) -> DataFrame:
    """The models (see ``FittedRatio``) of gram counts (code, allow, block), staged: level by level, a
    gram's probabilities from its counts, its context's and those of its shorter gram."""
    contexts = staged(counts.groupBy(F.shiftright("code", 8).alias("context")).agg(
        *(f(c).alias(f"{c}_{n}") for c in ("allow", "block") for n, f in (("all", F.sum), ("kinds", lambda c: F.count_if(F.col(c) > 0))))), "url_contexts")

    def p(side: str, shorter: Column) -> Column:
        kinds = F.col(f"{side}_kinds")
        return F.when(kinds > 0, (F.col(side) + kinds * shorter) / (F.col(f"{side}_all") + kinds)).otherwise(shorter)

    def weight(side: str) -> Column:
        kinds = F.col(f"{side}_kinds")
        return F.when(kinds > 0, F.ln(kinds / (F.col(f"{side}_all") + kinds))).otherwise(0.0)

    out, levels = None, []
    for k in range(order + 1):
        rows = (counts.where((F.col("code") >= 1 << 8 * (k + 1)) & (F.col("code") < 1 << 8 * (k + 2)))
                .join(contexts.hint("merge"), F.shiftright("code", 8) == F.col("context")))
        if k:
            shorter = levels[-1].select(F.col("code").alias("_code"), *(F.col(f"p_{s}").alias(f"_{s}") for s in ("allow", "block"))).hint("merge")
            rows = rows.join(shorter, F.col("code").bitwiseAND((1 << 8 * k) - 1) + (1 << 8 * k) == F.col("_code"))
        levels.append(staged(rows.select("code", *(p(s, F.col(f"_{s}") if k else F.lit(1 / 256)).alias(f"p_{s}") for s in ("allow", "block"))), "url_level"))
        after = F.shiftright("code", 8).bitwiseAND(255).cast("int") if k else F.lit(-1)
        grams = levels[-1].select(F.lit(True).alias("is_gram"), "code", (F.ln("p_allow") - F.ln("p_block")).alias("value"), after.alias("after"))
        out = grams if out is None else out.unionByName(grams)
    code = F.col("context")
    out = staged(out.unionByName(contexts.select(
        F.lit(False).alias("is_gram"), code.alias("code"), (weight("allow") - weight("block")).alias("value"),
        F.when(code == 1, -1).otherwise(code.bitwiseAND(255).cast("int")).alias("after"))), "url_model")
    for done in (contexts, *levels):
        drop(done)
    return out


def _numbered(urls: DataFrame) -> tuple[DataFrame, dict[str, int], DataFrame]:
    """``urls`` (url, verdict) with number, from 0 by verdict in the order of a hash, how many
    each verdict has, and the staged table it is made from. No task sorts more than a range of hashes; one row a range and
    verdict reaches the driver."""
    placed = staged(urls.withColumn("_hash", F.xxhash64("url")).repartitionByRange("_hash", "url")
                    .withColumn("_part", F.spark_partition_id()), "url_labels")
    before, total = [], {"allow": 0, "block": 0}
    for r in sorted(placed.groupBy("_part", "verdict").count().collect()):
        before.append((r._part, r.verdict, total[r.verdict]))
        total[r.verdict] += r["count"]
    starts = urls.sparkSession.createDataFrame(before, "_part int, verdict string, _before long")
    rank = F.row_number().over(Window.partitionBy("_part", "verdict").orderBy("_hash", "url"))
    out = placed.withColumn("_rank", rank).join(starts, ["_part", "verdict"]).select("url", "verdict", (F.col("_before") + F.col("_rank") - 1).alias("number"))
    return out, total, placed


def best_threshold(scores: DataFrame) -> float:
    """``calibrate`` over rows (verdict, score) of any number: each range of scores is summed
    beside the others, one row a range reaches the driver."""
    marks = staged(scores.groupBy("score").agg(F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block"))
                   .repartitionByRange("score").withColumn("_part", F.spark_partition_id()), "url_marks")
    parts = sorted(marks.groupBy("_part").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.min("score").alias("least")).collect())
    allow, block = sum(r.allow for r in parts), sum(r.block for r in parts)
    if not allow or not block:
        return 0.0
    starts, a, b = [], 0, 0
    for i, r in enumerate(parts):
        starts.append((r._part, a, b, parts[i + 1].least if i + 1 < len(parts) else None))
        a, b = a + r.allow, b + r.block
    known = scores.sparkSession.createDataFrame(starts, "_part int, _allow long, _block long, _next double")
    upto, whole = Window.partitionBy("_part").orderBy("score"), "decimal(19,0)"
    gain = ((F.col("_block") + F.sum("block").over(upto)).cast(whole) * F.lit(allow).cast(whole)
            - (F.col("_allow") + F.sum("allow").over(upto)).cast(whole) * F.lit(block).cast(whole))
    best = (marks.join(known, "_part").select("score", F.coalesce(F.lead("score").over(upto), "_next").alias("next"), gain.alias("gain"))
            .where("gain > 0").orderBy(F.desc("gain"), "score").first())
    drop(marks)
    if best is None:
        return parts[0].least
    return best.score + ((best.next - best.score) / 2 if best.next is not None else 1e-9)


def fit_ratio(labelled: DataFrame, order: int, sample: int | None, longest: int | None, held_out: int) -> tuple[FittedRatio, float] | None:
    """Fit on every different labelled URL (columns url, verdict). One in ``held_out`` of either
    verdict is kept for the threshold (with no more than that, all of them are used for
    both). None if a verdict has no URL. A caller may ask for the ``sample`` URLs of
    either verdict with the lowest hash, or for none longer than ``longest`` bytes."""
    if not 0 <= order <= 5:
        raise ValueError("order must be from 0 to 5")
    own = labelled.where(F.col("verdict").isin("allow", "block") & F.col("url").isNotNull())
    if longest is not None:
        own = own.where(F.octet_length("url") <= longest)
    urls, total, placed = _numbered(own.select("url", "verdict").distinct())
    if sample is not None:
        urls, total = urls.where(F.col("number") < sample), {v: min(n, sample) for v, n in total.items()}
    if not all(total.values()):
        return None
    few = [v for v, n in total.items() if n <= held_out]
    held, both = F.col("number") % held_out == 0, F.col("verdict").isin(few)
    counts = staged(urls.where(~held | both).select("url", "verdict").mapInArrow(_count_grams(order), "code long, allow long, block long")
                    .groupBy("code").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), "url_grams")
    ratio = FittedRatio(model_entries(counts, order), order)
    threshold = best_threshold(ratio.scored(urls.where(held | both)).select("verdict", "score"))
    for done in (counts, placed):
        drop(done)
    return ratio, threshold


def judge_urls(pages: DataFrame, rules: list[Rule], *, key: str = "page_id", url: str = "url", order: int = 4,
               sample: int | None = None, longest: int | None = None, held_out: int = 5) -> DataFrame:
    """Verdict for every URL: page_id, host, path, rule, verdict, score.

    The rules decide where one fits; the URLs that they decide are the labels the
    models learn from (all of them, see ``fit_ratio``). The rest is allowed
    when its score reaches the calibrated threshold; with no labelled URL on one
    side there is no model and the rest is allowed. NULL URLs and those without
    ``://`` have empty host and path, and NULL or empty ones score 0; NULL keys and
    repeated rows are kept; an empty table gives no rows; other columns are not read.
    """
    own = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"))
    ruled = own.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    ruled = ruled.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    verdict_of = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.verdict)]) if rules else None
    by_rule = F.try_element_at(verdict_of, F.col("rule")) if rules else F.lit(None).cast("string")
    model = fit_ratio(ruled.select("url", by_rule.alias("verdict")), order, sample, longest, held_out)
    scored, threshold = (ruled.withColumn("score", F.lit(0.0)), 0.0) if model is None else (model[0].scored(ruled), model[1])
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_model).alias("verdict"), "score")
