"""Wildcard patterns as column expressions.

Policy resources use ``*`` (any run) and ``?`` (one character); everything else
is literal. The conversion is a Column expression, so it runs JVM-side on
whole pattern columns: quote the pattern with ``\\Q..\\E`` and re-open the
quote around each wildcard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_to_regex(pattern: Column, ignore_case: Column | bool = False) -> Column:
    """'tbl*' -> '^\\Qtbl\\E.*\\Q\\E$' (quoted literal runs, wildcards open)."""
    # \E inside the literal would end the quote early; split it out first.
    safe = F.replace(pattern, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    body = F.replace(F.replace(safe, F.lit("*"), F.lit("\\E.*\\Q")), F.lit("?"), F.lit("\\E.\\Q"))
    rx = F.concat(F.lit("^\\Q"), body, F.lit("\\E$"))
    if isinstance(ignore_case, bool):
        return F.concat(F.lit("(?i)"), rx) if ignore_case else rx
    return F.when(ignore_case, F.concat(F.lit("(?i)"), rx)).otherwise(rx)


def has_wildcard(pattern: Column) -> Column:
    return pattern.contains("*") | pattern.contains("?")


def glob_match(value: Column, pattern: Column, ignore_case: Column | bool = False) -> Column:
    return F.regexp_like(value, glob_to_regex(pattern, ignore_case))
