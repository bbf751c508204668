"""Enrichment expressions shared by the silver transforms.

All are built-in column expressions (codegen, no Python per row).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score buckets (score >= 5 high, >= 1 medium, otherwise low —
# NULL scores land in "low") and the activity horizon in days.
SCORE_HIGH_MIN = 5
SCORE_MEDIUM_MIN = 1
ACTIVE_WITHIN_DAYS = 365


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def score_category(score: Column | str) -> Column:
    s = _c(score)
    return (F.when(s >= SCORE_HIGH_MIN, F.lit("high"))
            .when(s >= SCORE_MEDIUM_MIN, F.lit("medium"))
            .otherwise(F.lit("low")))


def text_length(text: Column | str) -> Column:
    """Characters (not bytes) of decoded text, 0 for NULL."""
    return F.coalesce(F.length(_c(text)), F.lit(0))


def non_empty_flag(text: Column | str) -> Column:
    """FALSE for NULL or empty text, TRUE otherwise."""
    return F.coalesce(_c(text) != F.lit(""), F.lit(False))


def timestamp_col(df, name: str) -> Column:
    """Column ``name`` of ``df`` as a timestamp.

    Timestamp (LTZ or NTZ) and date columns are used as they are, so NTZ
    input is never shifted by the session zone; strings parse leniently —
    NULL for unparsable text, the 3.5 behaviour the jobs were written
    against (4.1's ANSI ``to_timestamp`` would raise).
    """
    kind = df.schema[name].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.col(name)
    return F.try_to_timestamp(F.col(name).cast("string")).cast("timestamp_ntz")


def as_date(value) -> Column:
    """A run date parameter as a DATE column; ``None`` → ``current_date()``."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat()[:10]
    return F.lit(str(value)).cast("date")


def as_timestamp(value) -> Column:
    """A load/run time parameter as TIMESTAMP_NTZ; ``None`` → now."""
    if value is None:
        return F.localtimestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(value)).cast("timestamp_ntz")


def age_days(ts: Column | str, as_of=None) -> Column:
    return F.datediff(as_date(as_of), F.to_date(_c(ts)))


def is_active(last_access: Column | str, as_of=None) -> Column:
    """``age <= 365`` days; NULL access date stays NULL."""
    return age_days(last_access, as_of) <= ACTIVE_WITHIN_DAYS


