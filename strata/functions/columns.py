"""Column-name normalisation and per-dataset schema contracts.

Renaming is metadata only: one ``toDF(*names)`` per frame, no data is read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Substring fix-ups applied, in this order, after the
# split-caps rule of the notebook job.
SPLIT_CAPS_FIXUPS = [
    ("userid", "user_id"),
    ("postid", "post_id"),
    ("creationdate", "creation_date"),
    ("displayname", "display_name"),
    ("accountid", "account_id"),
    ("userdisplayname", "user_display_name"),
]

# Required columns per dataset (names only; extra columns are
# allowed), and the un-underscored spellings accepted in their place.
CONTRACTS = {
    "comments": {"id", "post_id", "text", "user_id", "creation_date"},
    "posts": {"id", "post_type_id", "creation_date"},
    "badges": {"id", "user_id", "name", "date"},
    "users": {"id", "display_name", "creation_date"},
}
CONTRACT_ALTERNATES = {
    "user_id": ["userid"],
    "post_id": ["postid"],
    "creation_date": ["creationdate"],
    "display_name": ["displayname"],
}

_CAMEL_WORD = re.compile(r"(.)([A-Z][a-z]+)")
_CAMEL_TAIL = re.compile(r"([a-z0-9])([A-Z])")


class SchemaContractError(ValueError):
    """A frame lacks columns its dataset contract requires."""


def split_caps_name(name: str) -> str:
    """Notebook rule: ``_`` before every non-initial ASCII capital, drop
    ``-`` and blanks, lower-case, then the substring fix-ups in order."""
    out = []
    for i, ch in enumerate(name):
        if i > 0 and "A" <= ch <= "Z":
            out.append("_")
        out.append(ch)
    s = "".join(out).replace("-", "").replace(" ", "").lower()
    for old, new in SPLIT_CAPS_FIXUPS:
        s = s.replace(old, new)
    return s


def two_pass_name(name: str) -> str:
    """Scheduled-job rule: split before capitalised words, then before a
    capital that follows a lower-case letter or digit; acronyms stay whole."""
    s = _CAMEL_WORD.sub(r"\1_\2", name)
    return _CAMEL_TAIL.sub(r"\1_\2", s).lower()


def standard_name(name: str) -> str:
    """Default: two-pass split, ``-``/blank become ``_``, and the fix-ups
    applied to whole names only (so ``owneruserid`` is not half-rewritten)."""
    s = two_pass_name(name).replace("-", "_").replace(" ", "_")
    whole = dict(SPLIT_CAPS_FIXUPS)
    return whole.get(s, s)


NORMALIZERS = {
    "split_caps": split_caps_name,
    "two_pass": two_pass_name,
    "standard": standard_name,
}


def normalized_names(names: list[str], mode: str = "standard") -> list[str]:
    try:
        fn = NORMALIZERS[mode]
    except KeyError:
        raise ValueError(f"unknown normalisation mode {mode!r}") from None
    new = [fn(n) for n in names]
    seen: dict[str, str] = {}
    for old, n in zip(names, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return new


def normalize_columns(df: DataFrame, mode: str = "standard") -> DataFrame:
    """Rename every column to snake_case in one metadata-only projection."""
    return df.toDF(*normalized_names(df.columns, mode))


def missing_columns(columns: list[str], dataset: str) -> list[str]:
    """Contract columns absent from ``columns`` (alternates count as present)."""
    required = CONTRACTS.get((dataset or "").lower())
    if required is None:
        return []
    have = set(columns)
    missing = []
    for req in sorted(required - have):
        if not any(a in have for a in CONTRACT_ALTERNATES.get(req, [])):
            missing.append(req)
    return missing


def check_contract(df: DataFrame, dataset: str, where: str = "") -> DataFrame:
    """Raise ``SchemaContractError`` naming the missing columns; else return df.

    Datasets without a contract pass unchecked. Only names are compared.
    """
    missing = missing_columns(df.columns, dataset)
    if missing:
        seen = ", ".join(sorted(df.columns)[:20])
        loc = f" ({where})" if where else ""
        raise SchemaContractError(
            f"{dataset}{loc}: missing required columns {missing}; present: {seen}")
    return df
