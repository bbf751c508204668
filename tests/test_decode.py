from pyspark.sql import functions as F

from strata.functions.decode import DECODE_ERROR_MARKER, decode_utf8, decoded_filter


def _bin(spark, values):
    return spark.createDataFrame([(None if v is None else bytearray(v),) for v in values],
                                 "b binary")


def test_strict_decode(spark):
    df = _bin(spark, [b"h\xc3\xa9llo", b"a\xffb", None])
    got = [r[0] for r in df.select(decode_utf8("b")).collect()]
    assert got == ["héllo", DECODE_ERROR_MARKER, None]


def test_ignore_decode_matches_python(spark):
    cases = [b"a\xffb\xe2\x82", b"\xc0\x80x", b"\xed\xa0\x80y", b"q\xf0\x9f\x98",
             "日本語 ok".encode(), b"", b"\xef\xbf\xbd real \xff", b"\xe2\xc3\xa9", b"\xf4\x90\x80\x80\n\xff",
             "é\n😀".encode() + b"\x80"]
    got = [r[0] for r in _bin(spark, cases).select(decode_utf8("b", "ignore")).collect()]
    assert got == [c.decode("utf-8", "ignore") for c in cases]
    assert got[:4] == ["ab", "x", "y", "q"]


def test_reference_filter_keeps_rows_1_and_3(spark):
    df = spark.createDataFrame([("ok",), (None,), ("[DECODE_ERROR: x]",), ("[DECODE_ERROR]",)],
                               "t string")
    kept = [r.t for r in df.where(decoded_filter(df, "t", "reference")).collect()]
    assert kept == ["ok", "[DECODE_ERROR: x]"]


def test_valid_filter_drops_only_failures(spark):
    marker = DECODE_ERROR_MARKER.encode()  # a text that only reads like a failure stays
    df = _bin(spark, [b"ok", None, b"a\xffb", marker])
    kept = [r.t for r in df.where(decoded_filter(df, "b", "valid")).select(decode_utf8("b").alias("t")).collect()]
    assert kept == ["ok", None, DECODE_ERROR_MARKER]


def test_decode_is_native(spark):
    df = _bin(spark, [b"x"]).select(decode_utf8("b").alias("t"), decode_utf8("b", "ignore"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_multibyte_roundtrip_on_documents(spark):
    from strata.sources.roles import documents_bronze
    d = documents_bronze(spark, "/root/testdata/sf0.001")
    raw = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    j = d.select("id", decode_utf8("text").alias("t")).join(
        raw.select(F.col("doc_id").alias("id"), "text"), "id")
    assert j.where(~(F.col("t") == F.col("text"))).count() == 0
    assert j.count() == raw.count()
