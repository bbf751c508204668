import subprocess
import sys

import public_tokenizers
import pytest

from strata.llm import packing
from strata.llm.common import member
from strata.llm.tokens import encoder


@pytest.mark.parametrize("module", ["lines", "jaccard"])
def test_workers_of_the_line_and_shingle_joins_do_not_load_pandas(module):
    code = f"import sys, strata.llm.{module}; print('pandas' in sys.modules)"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["False"]


def test_member_is_never_false_for_one_that_is(spark):
    ids = spark.createDataFrame([(1,), (-5,), (1 << 40,), (-(1 << 63),)], "id long")
    rows = spark.range(0, 50).selectExpr("id").union(ids)
    found = {r.id for r in rows.where(member(ids)("id")).collect()}
    assert {1, -5, 1 << 40, -(1 << 63)} <= found and not found & set(range(6, 50))


def test_a_packing_worker_keeps_a_bounded_number_of_chunks():
    enc = encoder(public_tokenizers.path("byte_bpe_50k.json"), True, packing.CACHED)
    words = [f" {chr(97 + i % 26)}{i}" for i in range(packing.CACHED + 20_000)]
    for i in range(0, len(words), 10_000):
        enc.encode(["".join(words[i:i + 10_000])])
    assert len(enc.cache) <= packing.CACHED <= 250_000 and packing.SLICE <= 1 << 20
