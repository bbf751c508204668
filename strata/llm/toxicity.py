"""Toxicity: gradient-boosted trees over dense text features, isotonic calibration.

Features are densities and rates of the whole text: two lexicons (a fixed seed
list, and words that the labelled sample ties to toxic documents), lexicon words
near a second-person pronoun, obfuscated spellings, capitals, punctuation. Trees
and calibration are Spark ML's, fitted on a bounded sample of labelled rows;
scoring is one pass over the documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import drop, id_remainder, identified, staged, text_slices, without_rows

SEED_LEXICON = frozenset("""
    ass asshole bastard bitch bullshit clown coward creep crap cretin cunt damn dick dickhead disgusting dumb dumbass
    dimwit fool freak fuck fucker fucking garbage hate hideous idiot idiotic imbecile jackass jerk kill liar loser
    lunatic moron moronic motherfucker nasty pathetic pig prick pussy rat scum scumbag shit shithead shut sick slut
    stupid sucker suck sucks trash trashy twat ugly useless vermin vile whore wimp worthless wretch
    arschloch blöd blödmann depp dreck dumm dummkopf hurensohn idiotisch scheiße scheisse trottel versager wichser
    abruti connard connasse crétin imbécile merde ordure pourriture salaud salope
    basura cabrón estúpido estúpida gilipollas imbécil mierda pendejo puta tonto
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur ya du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos
    tú ti tuyo usted ustedes vosotros vuestro
""".split())
#: What look-alike characters stand for.
LOOKALIKES = str.maketrans("013457@$!|+€", "oieastasiite")
FEATURES = ["seed_density", "seed_log_count", "seed_distinct", "learned_density", "learned_log_distinct",
            "near_you_density", "you_density", "disguised_density", "mixed_word_rate", "capital_rate", "shout_rate",
            "punctuation_rate", "exclamation_rate", "symbol_rate", "digit_rate", "log_words"]
_EDGE = re.compile(r"^\W+|\W+$")
_NOT_LETTER = re.compile(r"[\W_\d]")
_KINDS = np.zeros((256, 5))
for _c in range(256):
    _KINDS[_c] = [65 <= _c <= 90, _c < 128 and chr(_c) in ".,;:?!'\"-()", _c == 33,
                  _c < 128 and chr(_c) in "#$%&*@^~+=<>|/\\_", 48 <= _c <= 57]


def undisguised(word: str) -> str:
    """The word behind look-alike characters, separators and stretched letters."""
    plain = _NOT_LETTER.sub("", word.translate(LOOKALIKES))
    return re.sub(r"(.)\1{2,}", r"\1", plain)


def features_of(text: str, learned: frozenset[str], near: int = 3) -> list[float]:
    """FEATURES of a whole text; all 0 for an empty one."""
    raw = text.split()
    words = [w.lower() for w in raw]
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * len(FEATURES)
    seed, known, you, disguised, mixed = set(), set(), set(), set(), set()
    plain_of = {}
    for w in set(words):
        plain = w if w.isalpha() else _EDGE.sub("", w)
        plain_of[w] = plain
        if plain in SEED_LEXICON:
            seed.add(w)
        if plain in learned:
            known.add(w)
        if plain in SECOND_PERSON:
            you.add(w)
        if not plain.isalpha() or len(plain) > 5:
            if plain not in SEED_LEXICON and (undisguised(w) in SEED_LEXICON or undisguised(plain) in SEED_LEXICON):
                disguised.add(w)
            if not plain.isalpha() and any(c.isalpha() for c in plain):
                mixed.add(w)
    at_seed = [i for i, w in enumerate(words) if w in seed or w in disguised] if seed or disguised else []
    at_you = {i for i, w in enumerate(words) if w in you} if you else set()
    by_you = sum(any(j in at_you for j in range(i - near, i + near + 1)) for i in at_seed) if at_you else 0
    count = lambda some: sum(w in some for w in words) if some else 0
    kinds = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256) @ _KINDS / chars
    shouted = sum(len(w) > 2 and w.isupper() for w in set(raw))
    return [len(at_seed) / n, math.log1p(len(at_seed)), math.log1p(len({plain_of[w] for w in seed})),
            count(known) / n, math.log1p(len(known)), by_you / n, len(at_you) / n, count(disguised) / n,
            count(mixed) / n, kinds[0], shouted / n, kinds[1], kinds[2], kinds[3], kinds[4], math.log1p(n)]


def with_features(docs: DataFrame, learned: frozenset[str]) -> DataFrame:
    """doc_id (of any type) and features of every row (columns doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            rows = [features_of(t or "", learned) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "values"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, values array<double>")


def learned_lexicon(sample: DataFrame, size: int, least: int, odds: float) -> frozenset[str]:
    """Up to ``size`` words in at least ``least`` toxic documents of the sample whose
    smoothed document odds there are ``odds`` times those elsewhere."""
    split = sample.select("doc_id", "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("word"))
    plain = F.regexp_replace("word", r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    words = split.select("doc_id", "toxic", plain.alias("word")).where("word <> '' and length(word) <= 64").distinct()
    counts = words.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"))
    n = sample.agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")).first()
    ratio = ((F.col("bad") + 0.5) / (n.bad + 1)) / ((F.col("good") + 0.5) / (n.good + 1))
    top = (counts.where(F.col("bad") >= least).withColumn("ratio", ratio).where(F.col("ratio") >= odds)
           .orderBy(F.desc(F.col("bad") * F.log("ratio")), "word").limit(size).collect())
    return frozenset(r.word for r in top)


@dataclass
class ToxicityModel:
    learned: frozenset[str]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float  # the score of every text if there are no trees

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id and score of every row (columns doc_id, text)."""
        if self.trees is None:
            return docs.select("doc_id", F.lit(self.rate).alias("score"))
        raw = _raw(self.trees, with_features(docs, self.learned))
        return self.calibration.transform(raw).select("doc_id", F.col("prediction").alias("score"))


def _raw(trees: GBTClassificationModel, features: DataFrame) -> DataFrame:
    out = trees.transform(features.withColumn("features", array_to_vector("values")))
    return out.withColumn("raw", vector_to_array("probability")[1]).drop("prediction", "probability", "rawPrediction", "features")


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, *, sample: int = 12_000,
        longest: int = 100_000, trees: int = 20, depth: int = 3, lexicon: int = 200) -> ToxicityModel:
    """Fit on labelled documents (docs: doc_id, text; labels: doc_id, toxic).

    ``learn`` restricts the rows learned from (default: crc32 of doc_id modulo 5 is
    not 0). The sample holds the ``sample`` of these with the lowest hash of doc_id,
    none over ``longest`` characters; one in four calibrates, the rest grows the trees. A
    document labelled more than once is toxic if one label says so; NULL labels are
    none. If the sample lacks one of the classes there are no trees and every score
    is the share of toxic rows (0 without any).
    """
    learn = F.coalesce(id_remainder(F.col("doc_id"), 5) != 0 if learn is None else learn, F.lit(False))
    toxic = (labels.where("doc_id is not null and toxic is not null").where(learn)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= longest)
    ids = own.select("doc_id").join(toxic, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    one = F.min_by(F.struct("text", "toxic"), F.struct(F.xxhash64("text"), "text"))  # of several texts under one key
    rows = staged(own.join(ids, "doc_id").groupBy("doc_id").agg(one.alias("one")).select("doc_id", "one.*")
                  .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4))), "toxicity_sample")
    counts = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    fold = {(r.calibrates, r.toxic): r.n for r in rows.groupBy((F.col("fold") == 0).alias("calibrates"), "toxic")
            .agg(F.count("*").alias("n")).collect()}
    if not all(fold.get((False, t)) for t in (0, 1)):
        return ToxicityModel(frozenset(), None, None, (counts.bad or 0) / counts.n if counts.n else 0.0)
    growing = rows.where("fold <> 0")
    learned = learned_lexicon(growing, lexicon, least=5, odds=8.0)
    featured = staged(with_features(rows, learned).join(rows.select("doc_id", "toxic", "fold"), "doc_id").coalesce(4),
                      "toxicity_features")
    grown = GBTClassifier(labelCol="toxic", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1, maxBins=64).fit(
        featured.where("fold <> 0").withColumn("features", array_to_vector("values")))
    apart = featured.where("fold = 0") if all(fold.get((True, t)) for t in (0, 1)) else featured
    calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic").fit(
        _raw(grown, apart).select("raw", F.col("toxic").cast("double").alias("toxic")))
    drop(rows)
    drop(featured)
    return ToxicityModel(learned, grown, calibration, counts.bad / counts.n)


def score_documents(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows doc_id, held_out, score, predicted for every document.

    NULL or empty text has all features 0 and the score that the model gives those;
    a NULL key counts as '' for the fold; repeated rows are scored each; an empty
    table gives no rows; other columns are not read.
    """
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = fit(own, labels, **options).score(own)
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = 0.5,
               **options) -> DataFrame:
    """``docs`` with all their columns, without the documents scored ``threshold`` or
    more; every row goes by its own text, whatever its key."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    model = fit(own, labels, **options)
    rows = identified(docs, key, text, numbered=False)  # equal texts have equal scores
    places = F.struct("_doc", "_part")
    scored = model.score(rows.select(places.alias("doc_id"), F.col(text).cast("string").alias("text")))
    bad = scored.where(F.col("score") >= threshold).select("doc_id._doc", "doc_id._part")
    return without_rows(rows, staged(bad, "toxic_documents"))
