"""Text and query-text column functions (FN6-FN8, FN14, FN17)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must equal the reference's behaviour; (?U) makes \w, \s and \b
# cover all of Unicode.  Fixed values.
TABLE_AFTER_FROM_JOIN = r"(?iU)\b(?:FROM|JOIN)\s+([^\s;]+)"
COUNT_STAR = r"COUNT\(\*\)"
DESTRUCTIVE_ANYWHERE = r"(?i)(drop|delete)"
LEADING_DROP_ALTER = r"(?iU)^\s*\b(drop|alter)\b"
TRUNCATE_AT = 300
TRUNCATE_SUFFIX = "... truncated ..."


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def table_names(query) -> Column:
    """FN6: array of table names following FROM / JOIN (case-insensitive)."""
    return F.regexp_extract_all(_c(query), F.lit(TABLE_AFTER_FROM_JOIN), 1)


def count_to_select(query) -> Column:
    """FN7: ``COUNT(*)`` (case-sensitive) rewritten to ``*``."""
    return F.regexp_replace(_c(query), COUNT_STAR, "*")


def has_destructive_word(query) -> Column:
    """FN8: drop/delete anywhere in the text, any case."""
    return _c(query).rlike(DESTRUCTIVE_ANYWHERE)


def starts_with_drop_alter(query) -> Column:
    """FN8: statement that begins with drop/alter, any case."""
    return _c(query).rlike(LEADING_DROP_ALTER)


def is_destructive_text(text: str) -> bool:
    """Driver-side guard for a single statement (same rule as FN8)."""
    return re.search(r"(drop|delete)", text, flags=re.IGNORECASE) is not None


def is_leading_drop_alter(text: str) -> bool:
    return re.search(r"^\s*\b(drop|alter)\b", text, flags=re.IGNORECASE) is not None


def encode_path(col) -> Column:
    """FN14: ``=`` → ``-`` and ``/`` → ``_``."""
    return F.translate(_c(col), "=/", "-_")


def decode_path(col) -> Column:
    """FN14 inverse (lossy when the text already held ``-`` or ``_``)."""
    return F.translate(_c(col), "-_", "=/")


def truncate_message(col, max_len: int = TRUNCATE_AT, suffix: str = TRUNCATE_SUFFIX) -> Column:
    """FN17: cut at ``max_len`` characters and mark the cut."""
    c = _c(col)
    return F.when(F.length(c) > max_len, F.concat(F.substring(c, 1, max_len), F.lit(suffix))).otherwise(c)


def strip_spaces(col) -> Column:
    """Leading and trailing whitespace removed (Python's ``str.strip``)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")
