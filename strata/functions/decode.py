"""Binary → text decoding as native Catalyst expressions.

Bronze text columns arrive as UTF-8 bytes (``BinaryType``). Decoding runs
inside whole-stage codegen: ``is_valid_utf8`` guards a plain cast, so no
Python worker is involved and filters/projections around it still push down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

# The marker a failed strict decode produces, and the token the
# reference-compatible filter looks for (it never matches the marker's
# prefix-with-reason form, see decoded_filter).
DECODE_ERROR_MARKER = "[DECODE_ERROR: invalid UTF-8]"
DECODE_ERROR_TOKEN = "[DECODE_ERROR]"

# Fixed rule: the well-formed UTF-8 byte sequences (Unicode standard, table 3-7),
# over bytes seen as ISO-8859-1 characters; any other byte is dropped.
_WELL_FORMED = (r"(?s)([\x00-\x7F]|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]"
                r"|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
                r"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}"
                r"|\xF4[\x80-\x8F][\x80-\xBF]{2})|.")


def decode_utf8(col: Column | str, errors: str = "strict") -> Column:
    """Decode UTF-8 bytes.

    ``strict``: NULL stays NULL, valid bytes become their text, invalid bytes
    become ``DECODE_ERROR_MARKER``.
    ``ignore``: bytes outside well-formed sequences are dropped (Python's
    ``errors='ignore'``); everything else stays, a genuine U+FFFD too.
    """
    b = F.col(col) if isinstance(col, str) else col
    if errors == "strict":
        return (F.when(b.isNull(), F.lit(None).cast("string"))
                .when(F.is_valid_utf8(b), b.cast("string"))
                .otherwise(F.lit(DECODE_ERROR_MARKER)))
    if errors == "ignore":
        kept = F.regexp_replace(F.decode(b, "ISO-8859-1"), _WELL_FORMED, "$1")
        return (F.when(F.is_valid_utf8(b), b.cast("string"))
                .otherwise(F.encode(kept, "ISO-8859-1").cast("string")))
    raise ValueError(f"errors must be 'strict' or 'ignore', got {errors!r}")


def decode_text_columns(df: DataFrame, names: list[str], errors: str = "strict") -> DataFrame:
    """Decode the listed columns that are binary; string columns pass through.

    One projection (``withColumns``) so Catalyst sees a single Project.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    todo = {n: decode_utf8(n, errors) for n in names
            if n in types and isinstance(types[n], BinaryType)}
    return df.withColumns(todo) if todo else df


def undecodable(df: DataFrame, name: str) -> Column:
    """TRUE for rows whose ``name`` holds bytes that are not UTF-8 (FALSE for NULL
    and for text columns, which were decoded before)."""
    if not isinstance(df.schema[name].dataType, BinaryType):
        return F.lit(False)
    return ~F.coalesce(F.is_valid_utf8(F.col(name)), F.lit(True))


def decoded_filter(df: DataFrame, name: str, mode: str = "valid") -> Column:
    """Rows to keep of a frame whose ``name`` is still in bytes, before a strict decode.

    ``valid`` (default): drop rows whose bytes are not UTF-8; NULL text stays,
    and so does text that happens to read like the marker.
    ``reference``: keep rows where ``NOT contains(decoded text,
    '[DECODE_ERROR]')`` is TRUE — NULL text is dropped and rows carrying the
    marker survive, exactly as the original job behaved.
    ``none``: keep every row.
    """
    if mode == "valid":
        return ~undecodable(df, name)
    if mode == "reference":
        text = F.col(name)
        if isinstance(df.schema[name].dataType, BinaryType):
            text = decode_utf8(name)
        return F.coalesce(~text.contains(DECODE_ERROR_TOKEN), F.lit(False))
    if mode == "none":
        return F.lit(True)
    raise ValueError(f"mode must be 'valid', 'reference' or 'none', got {mode!r}")
