"""String helpers (S23-S28) as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions._col import as_col

__all__ = [
    "join_set", "to_csv", "join_list", "capitalise_first", "lowercase_first", "zeros", "repeat_char",
    "is_empty", "is_blank", "matches_plain_text", "PLAIN_TEXT_PATTERN",
]

# ---- fixed values (must equal the source system's) -------------------------
# Whole-string check: CJK ideographs, latin letters, digits and listed punctuation.
PLAIN_TEXT_PATTERN = "^[\u4e00-\u9fa5a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)\"]+$"
# -----------------------------------------------------------------------------


def join_set(arr, sep: str = ",") -> Column:
    """S23 comma join of a set, in sorted order so that the text is deterministic."""
    return F.array_join(F.array_sort(F.array_distinct(as_col(arr))), sep)


def join_list(arr, sep: str) -> Column:
    """S24 ``join(list, d)``; null list -> null."""
    return F.array_join(as_col(arr), sep)


def to_csv(arr) -> Column:
    """S24 ``toCsv(list)``: ', ' separated."""
    return join_list(arr, ", ")


def capitalise_first(s) -> Column:
    """S25 upper-case the first character only (unlike ``initcap``)."""
    c = as_col(s)
    return F.when(F.length(c) > 0, F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))).otherwise(c)


def lowercase_first(s) -> Column:
    """S25 lower-case the first character only."""
    c = as_col(s)
    return F.when(F.length(c) > 0, F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))).otherwise(c)


def repeat_char(ch: str, n) -> Column:
    """S26 ``repeat(c, n)``."""
    return F.repeat(F.lit(ch), as_col(n) if not isinstance(n, int) else F.lit(n))


def zeros(n) -> Column:
    """S26 ``zeros(n)``."""
    return repeat_char("0", n)


def is_empty(s) -> Column:
    """S27 null or empty."""
    c = as_col(s)
    return F.coalesce(F.length(c) == 0, F.lit(True))


def is_blank(s) -> Column:
    """S27 null, or only code points <= U+0020 (the JVM ``trim`` rule)."""
    c = as_col(s)
    return F.coalesce(F.length(F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")) == 0, F.lit(True))


def matches_plain_text(s) -> Column:
    """S28 anchored whole-match of :data:`PLAIN_TEXT_PATTERN`; null -> null."""
    return as_col(s).rlike(PLAIN_TEXT_PATTERN)
