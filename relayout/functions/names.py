"""Name functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_match(col: Column, pattern: str) -> Column:
    """True when the *whole* value matches the Java regex ``pattern`` (case-sensitive).

    ``rlike`` alone is a substring search, and ``^...$`` still accepts a trailing newline; ``\\A``
    and ``\\z`` pin the match to the first and last character. A quotation left open (``\\Q`` without
    ``\\E``) runs to the end of the pattern, as it does on its own.
    """
    if pattern.rfind(r"\Q") > pattern.rfind(r"\E"):
        pattern += r"\E"
    return col.rlike(r"\A(?:" + pattern + r")\z")


def folded(col: Column) -> Column:
    """Names are addressed case-insensitively: both sides of a lookup are lower-cased."""
    return F.lower(col)


def glob_match(col: Column, pattern: str) -> Column:
    """True when the whole name matches a catalog listing's pattern, case-insensitively: ``*`` is any run of
    characters, ``|`` separates alternatives, any other character is itself."""
    parts = [".*".join(re.escape(x) for x in alternative.strip().split("*")) for alternative in pattern.lower().split("|")]
    return folded(col).rlike(r"(?s)\A(?:" + "|".join(parts) + r")\z")
