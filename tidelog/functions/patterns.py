"""Wildcard lists over database and table names."""

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def like_pattern(pattern: str) -> str:
    """`*` and `?` to LIKE's `%` and `_`; LIKE's own special characters become literals."""
    literal = {"%": "\\%", "_": "\\_", "\\": "\\\\", "*": "%", "?": "_"}
    return "".join(literal.get(ch, ch) for ch in pattern)


def wildcard_match(col: Column, pattern: str) -> Column:
    """`*` is any run of characters, `?` exactly one; whole text, case-sensitive.

    Literal beginnings and ends are tested as such, because those tests reach the parquet scan; a LIKE with an escape
    (every `app_*` needs one) does not.
    """
    if "?" not in pattern and pattern.count("*") <= 1:
        head, star, tail = pattern.partition("*")
        if not star:
            return col == pattern
        tests = [test for text, test in ((head, col.startswith(head)), (tail, col.endswith(tail))) if text]
        if head and tail:
            tests.append(F.length(col) >= len(head) + len(tail))
        return reduce(and_, tests, col.isNotNull())
    match = col.like(like_pattern(pattern))
    head = re.split(r"[*?]", pattern, maxsplit=1)[0]
    return col.startswith(head) & match if head else match


def split_patterns(text: str | None) -> list[str]:
    """Comma list to trimmed patterns without the empty ones."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def any_match(col: Column, patterns: str | None) -> Column:
    """True where one pattern of the comma list matches; an empty list matches everything."""
    parts = split_patterns(patterns)
    if not parts:
        return F.lit(True)
    return reduce(or_, [wildcard_match(col, part) for part in parts])


def pattern_filter(databases: str | None = "", tables: str | None = "") -> Column | None:
    """The test for wanted databases and tables; none where everything is wanted."""
    tests = [any_match(F.col(c), p) for c, p in (("db_name", databases), ("table_name", tables)) if split_patterns(p)]
    return reduce(and_, tests) if tests else None


def filter_changes(
    df: DataFrame,
    databases: str | None = "",
    tables: str | None = "",
    db_col: str = "db_name",
    table_col: str = "table_name",
) -> DataFrame:
    """Keep the rows of the wanted databases and tables."""
    if split_patterns(databases):
        df = df.filter(any_match(F.col(db_col), databases))
    if split_patterns(tables):
        df = df.filter(any_match(F.col(table_col), tables))
    return df
