"""Scalar column expressions for names, addresses, delimited lists, ids and labels.

Everything here returns a ``Column`` built from Spark built-ins, so it stays inside
whole-stage codegen and is pushed through Catalyst like any other expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Corporate suffixes stripped from the end of a lower-cased name,
# applied one after the other in exactly this order, each at most once.
SUFFIX_PATTERNS = [
    r"\s+inc\.?$",
    r"\s+incorporated$",
    r"\s+corp\.?$",
    r"\s+corporation$",
    r"\s+ltd\.?$",
    r"\s+limited$",
    r"\s+llc$",
    r"\s+co\.?$",
    r"\s+company$",
]

# Java regex flags: (?U) makes \s Unicode-aware, (?d) makes `$` treat only "\n" as a line end.
_FLAGS = "(?U)(?d)"
# Letters, numbers of any kind and the underscore are word characters; combining marks, joiners and
# other connectors are not.  The separators U+001C-U+001F count as white space.
WORD_CHARS = r"\p{L}\p{N}_"
SPACE = r"[\s\x1c-\x1f]"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name(name: ColumnOrName) -> Column:
    """Lower-case, strip legal suffixes, turn punctuation into spaces, squeeze spaces.

    null and "" give "".
    """
    out = F.lower(_col(name))
    for pattern in SUFFIX_PATTERNS:
        out = F.regexp_replace(out, _FLAGS + pattern.replace(r"\s", SPACE), "")
    out = F.regexp_replace(out, f"{_FLAGS}[^{WORD_CHARS}{SPACE[1:]}", " ")
    out = F.regexp_replace(out, f"{_FLAGS}{SPACE}+", " ")
    out = F.regexp_replace(out, f"{_FLAGS}^{SPACE}+|{SPACE}+$", "")
    return F.coalesce(out, F.lit(""))


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only removes spaces)."""
    return F.regexp_replace(_col(c), f"{_FLAGS}^{SPACE}+|{SPACE}+$", "")


def extract_city(address: ColumnOrName) -> Column:
    """Second comma-separated part of an address, stripped and lower-cased; "" when absent."""
    second = F.get(F.split(_col(address), ",", -1), 1)
    return F.coalesce(F.lower(strip_ws(second)), F.lit(""))


def list_size(c: ColumnOrName, sep: str = ";", on_null: int | None = -1) -> Column:
    """Number of ``sep``-separated items; "" counts as one item, null gives ``on_null``.

    The rule is written out so it does not depend on the ANSI / legacy sizeOfNull setting.
    """
    c = _col(c)
    pattern = "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep
    return F.when(c.isNull(), F.lit(on_null).cast("int")).otherwise(F.size(F.split(c, pattern, -1)))


def block_key(c: ColumnOrName, n: int = 3) -> Column:
    """First ``n`` characters (shorter strings give a shorter key)."""
    return F.substring(_col(c), 1, n)


def format_id(rank: ColumnOrName, prefix: str = "CORP_", width: int = 6) -> Column:
    """``prefix`` + rank left-padded with zeros to ``width``.

    ``lpad`` alone would cut ranks wider than ``width`` (so ids would collide once a
    registry passes 999,999 entities); wider ranks keep all their digits instead.
    """
    digits = _col(rank).cast("long").cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


def parse_id(c: ColumnOrName, sep: str = "_") -> Column:
    """Integer after the separator of an id such as CORP_000123 (null when malformed)."""
    return F.get(F.split(_col(c), sep, 2), 1).try_cast("long")


def binary_label(c: ColumnOrName, threshold: float) -> Column:
    """1 when the value is strictly above ``threshold``, else 0 (null gives 0)."""
    return F.when(_col(c) > F.lit(threshold), 1).otherwise(0)


def categorize(c: ColumnOrName, threshold: float, high: str = "High", low: str = "Low") -> Column:
    """CASE WHEN c > threshold THEN 'High' ELSE 'Low' (null gives 'Low')."""
    return F.when(_col(c) > F.lit(threshold), F.lit(high)).otherwise(F.lit(low))
