"""Language identification with a string kernel.

The kernel of two texts is the blended-spectrum presence kernel: how many distinct
character n-grams of one to three letters both hold, over the geometric mean of their own
numbers. A Nyström map spans its feature space by a few landmark texts of every language,
and one-versus-rest kernel ridge regression learns a decision value for each language there.

With X the batch's n-gram presence (texts x n-grams of the landmarks), L that of the
landmarks and W what the regression learned, the values of a batch are (X Lᵀ) W. Lᵀ W is
made once at the fit, so a batch is scored by one sparse matrix product, whatever the
number of landmarks.

Texts are lower-cased; all between letters counts as one blank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import id_remainder, staged, text_slices

UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Lower case of every code point that is a letter, the blank for all others."""
    return np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 32 for i in range(0x110000)], np.int64)


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.append(True, ordered[1:] != ordered[:-1])]


def grams(text: str) -> np.ndarray:
    """Distinct n-grams of one to three letters or blanks, 21 bits a letter; none if the
    text has no letter. The shorter ones are the beginnings of those of three."""
    c = _letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    full = np.nonzero(c != 32)[0]
    if not len(full):
        return np.empty(0, np.int64)
    c = c[full[0]:full[-1] + 1]
    c = np.concatenate([[32], c[(c != 32) | np.append(True, c[:-1] != 32)], [32, 32]])
    three = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
    three.sort()
    three = _distinct(three)
    return np.concatenate([_distinct(three >> 42), _distinct(three >> 21), three])


@dataclass(frozen=True)
class Presence:
    """N-gram presence of texts among the n-grams ``known`` (ascending): a sparse 0/1 matrix
    by rows, and the number of n-grams of every text, known or not."""

    columns: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray], known: np.ndarray) -> "Presence":
        every = np.concatenate(sets) if sets else np.empty(0, np.int64)
        sizes = np.array([len(s) for s in sets], np.int64)
        at = np.searchsorted(known, every)
        here = np.nonzero(known[np.minimum(at, len(known) - 1)] == every)[0] if len(known) else np.empty(0, np.int64)
        starts = np.searchsorted(here, np.append(0, np.cumsum(sizes)))
        return cls(at[here], starts, sizes)

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The matrix product with ``matrix`` (known n-grams x k), each row over the square
        root of its text's n-grams."""
        out = np.zeros((len(self.sizes), matrix.shape[1]))
        full = np.nonzero(np.diff(self.starts))[0]
        room = max(1, (1 << 22) // max(1, matrix.shape[1]))  # n-grams whose rows of the matrix are held at once
        at = 0
        while at < len(full):
            begin = self.starts[full[at]]
            to = max(at + 1, int(np.searchsorted(self.starts[full + 1], begin + room, "right")))
            end = self.starts[full[to - 1] + 1]
            if end - begin <= room:
                out[full[at:to]] = np.add.reduceat(matrix[self.columns[begin:end]], self.starts[full[at:to]] - begin, axis=0)
            else:  # one very long text
                out[full[at]] = sum(matrix[self.columns[i:min(i + room, end)]].sum(0) for i in range(begin, end, room))
            at = to
        return out / np.sqrt(np.maximum(self.sizes, 1))[:, None]


@dataclass(frozen=True)
class Model:
    """Languages, the landmarks' n-grams, their weights (n-grams x languages), the
    languages' offsets and the sharpness of the scores."""

    languages: list[str]
    known: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    sharpness: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of every text."""
        sets = [grams(t or "") for t in texts]
        names, score = [UNKNOWN] * len(sets), np.zeros(len(sets))
        if self.languages:
            shares = _shares(Presence.of(sets, self.known).times(self.weights) + self.offsets, self.sharpness)
            best = shares.argmax(1)
            some = np.array([len(s) > 0 for s in sets], bool)
            names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), some.tolist())]
            score[some] = shares.max(1)[some] if len(sets) else 0
        return names, score


def _shares(values: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp(sharpness * (values - values.max(1, keepdims=True))) if len(values) else values
    return e / e.sum(1, keepdims=True)


def _sample(docs: DataFrame, rows: int, languages: int) -> tuple[DataFrame, int]:
    """(lang, text, rank) of about ``rows`` rows shared evenly by the ``languages`` most
    frequent languages, those of the lowest hashes of row and text (``rank`` from 0), and
    the number of languages. Only rows below a hash that their language's count gives are
    moved."""
    place = F.shiftrightunsigned(F.xxhash64("text", "key"), 1) / F.lit(float(1 << 63))
    counts = staged(docs.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(languages), "languages")
    n = counts.count()
    most = max(2, rows // max(1, n))
    near = (docs.withColumn("_at", place).join(F.broadcast(counts), "lang")  # ``languages`` rows at most
            .where(F.col("_at") * F.col("_n") <= 1.2 * most + 20))
    by = Window.partitionBy("lang").orderBy("_at", "text")
    ranked = near.withColumn("rank", F.row_number().over(by) - 1).where(F.col("rank") < most)
    return staged(ranked.select("lang", "text", "rank"), "language_sample"), n


def fit(docs: DataFrame, *, rows: int = 2000, landmarks: int = 256, languages: int = 500, ridge: float = 0.005) -> Model:
    """Learn from ``docs`` (key, text, lang; neither of the last two NULL): a sample of about
    ``rows`` rows, ``landmarks`` of them landmarks, shared evenly by the ``languages`` most
    frequent languages (at least two rows and one landmark each). Tasks make n-grams and
    kernel values; the driver gets the landmarks' n-grams and rows x landmarks kernel values."""
    sample, n = _sample(docs, rows, languages)
    landmarks = max(1, landmarks // max(1, n))

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            yield pa.record_batch([b.column(0), b.column(2), pa.array([grams(t) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))],
                                  names=["lang", "rank", "grams"])

    chosen = (sample.where(F.col("rank") < landmarks).mapInArrow(grams_of, "lang string, rank int, grams array<long>")
              .where(F.size("grams") > 0).orderBy("lang", "rank").collect())
    languages = sorted({r.lang for r in chosen})
    if not languages:
        return Model([], np.empty(0, np.int64), np.empty((0, 0)), np.empty(0), 1.0)
    sets = [np.array(r.grams, np.int64) for r in chosen]
    known = np.unique(np.concatenate(sets))
    marks = Presence.of(sets, known)
    # landmarks by n-grams, each column over the root of the landmark's n-grams
    spectrum = np.zeros((len(known), len(sets)))
    spectrum[marks.columns, np.repeat(np.arange(len(sets)), np.diff(marks.starts))] = 1
    spectrum /= np.sqrt(marks.sizes)
    shared = docs.sparkSession.sparkContext.broadcast((known, spectrum.astype(np.float32)))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            own = [grams(t) for t in b.column(1).to_pylist()]
            values = Presence.of(own, shared.value[0]).times(shared.value[1])
            yield pa.record_batch([b.column(0), pa.array(list(values), pa.list_(pa.float64())), pa.array([len(x) > 0 for x in own])],
                                  names=["lang", "kernel", "some"])

    taken = (sample.where(F.col("lang").isin(languages)).repartition(8).mapInArrow(kernel, "lang string, kernel array<double>, some boolean")
             .where("some").orderBy("lang", "kernel").collect())
    shared.destroy()
    label = np.searchsorted(languages, [r.lang for r in taken])
    size, basis = np.linalg.eigh(spectrum.T @ spectrum)  # of the landmarks' own kernel
    use = size > 1e-6 * size.max()
    basis = basis[:, use] / np.sqrt(size[use])  # Nyström map of a row of kernel values
    features = np.column_stack([np.array([r.kernel for r in taken]) @ basis, np.ones(len(taken))])
    weight = (1 / np.bincount(label, minlength=len(languages)))[label][:, None]  # every language counts the same
    target = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    penalty = ridge * np.eye(features.shape[1])
    penalty[-1, -1] = 1e-9
    learned = np.linalg.solve(features.T @ (weight * features) + penalty, features.T @ (weight * target))
    values = features @ learned
    loss = {s: -(weight[:, 0] * np.log(_shares(values, s)[np.arange(len(label)), label] + 1e-12)).sum() for s in (1, 2, 3, 5, 8, 12)}
    return Model(languages, known, spectrum @ (basis @ learned[:-1]), learned[-1], float(min(loss, key=loss.get)))


def predict(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: the key, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 1 << 20, "_text"):
            names, score = shared.value.predict(b.column(1).to_pylist())
            yield pa.record_batch([b.column(0), pa.array(names, pa.string()), pa.array(score)], names=["_key", "lang_pred", "score"])

    own = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
    return own.mapInArrow(run, "_key long, lang_pred string, score double").withColumnRenamed("_key", key)


def identify(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, fold: int = 1,
             rows: int = 2000, landmarks: int = 256) -> DataFrame:
    """Key, held_out, lang_pred and score (0 to 1: the share of the language's value among
    all) of every whole text, learned from the rows that are not held out (crc32 of the key
    as text modulo ``folds`` is ``fold``; a NULL key counts as '').

    NULL texts and texts without a letter are ``und`` with score 0, as is every text if no
    row can be learned from. Rows with a NULL text or lang teach nothing; a language with
    few rows is learned from all of them; repeated rows and keys stay rows of their own and
    equal texts get equal results; an empty table gives no rows; other columns are not read.
    """
    held_out = id_remainder(F.col(key), folds) == fold
    taught = docs.where(~held_out & F.col(text).isNotNull() & F.col(lang).isNotNull())
    model = fit(taught.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"),
                              F.col(lang).cast("string").alias("lang")), rows=rows, landmarks=landmarks)
    return predict(docs, model, key=key, text=text).select(key, held_out.alias("held_out"), "lang_pred", "score")
