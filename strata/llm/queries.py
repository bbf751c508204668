"""The registered queries of the training-data operators and their oracles."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (bitpack, fingerprints, jaccard, language, lines, mixing, nndescent, oracle_sql, packing,
                        ppm, prefixtrie, runs, toxicity, urls)
from strata.llm.common import importable, table
from strata.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, str(sf_dir).rstrip("/"))
        run.__name__, run.__doc__, run.__wrapped__ = fn.__name__, fn.__doc__, fn
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        capacity=2048, end_id=0)


@register("op9_token_bit_packing")
def op9_token_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", "token_files")
    bitpack.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"),
                      vocabulary=49_408, end_id=2)
    return bitpack.read_documents(spark, path)


URL_RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"),
             urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"),
             urls.Rule("block", "com", "/de/")]


@register("op4_url_filter")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@register("op8_imatch_fingerprints")
def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@register("op2_ppm_scoring")
def op2_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(table(spark, sf_dir, "documents"))


@register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents"), width=3, percent=90)


@register("op5_nn_descent")
def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Whole-number weights by level and name (1 where none is given).
MIX_WEIGHTS = {"domain": {"domain0": 3, "domain1": 2}, "lang": {"en": 4, "de": 2}, "source": {"src0": 2}}


def mix_levels() -> dict:
    """Domain (four groups of sources), language, source."""
    number = F.try_to_number(F.regexp_extract("source", "([0-9]{1,9})", 1), F.lit("999999999"))
    return {"domain": F.concat(F.lit("domain"), (number.cast("long") % 4).cast("string")), "lang": F.col("lang"),
            "source": F.col("source")}


@register("op6_source_mixing", oracle_sql.SOURCE_MIXING)
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, share_of_tokens=0.6, epochs=3, seed=1)


@register("op10_fuzzy_line_dedup")
def op10_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words to take: every tenth document (by checksum of its id) loops from
    some word on. A document without an id stays as it is."""
    if doc_id is None or n == 0 or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


@register("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), min_length=6, repeats=4, word_order=looped)
    return runs.run_digests(found)


@register("op12_string_kernel_language")
def op12_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@register("op13_conversation_trie")
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = prefixtrie.numbered_turns(table(spark, sf_dir, "conversations"))
    return prefixtrie.prefix_trie(prefixtrie.grafted(turns, convs), convs)
