"""Quality rules, line first: judge each line, drop the lines that fail, then reject texts that lose too much.

Everything is an expression over the row's own text: no shuffle, no Python, and a hot source or a group of copies is
only more rows. Words are as in `common.words`.

Defined cases: a null text counts as empty; an empty or blank text has no words and fails the base rule; a very long
text is one row's arrays; repeated rows are judged each for itself; other columns, whatever their names, stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, as_rows, stored, words

# Fixed values of the base rules.
SYMBOL = r"[#*$%&|<>]"
SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# A line with one of these is boilerplate.
BOILERPLATE = (
    r"(?i)\b(all rights reserved|licensed under|(un)?released under the|license, version|terms of (use|service)"
    r"|privacy policy|cookie policy|cookies to|enable javascript|lorem ipsum|copyright (\(c\)|©|\d{4})|sign up for our"
    r"|subscribe to our|click here|powered by)\b"
)
# A line with so many of these is a path or a bar of links; so is one that is only such a word.
SEPARATOR = "[|»›·•>]"
MIN_SEPARATORS = 3
NAVIGATION = r"(?i)^\s*(home|menu|login|search|next|previous|back to top)\s*$"
SENTENCE_END = r"[.!?。！？…;:]"
MAX_UNENDED_WORDS = 60
MAX_SYMBOLS_PER_WORD = 0.5
MAX_SHOUTED_WORDS = 3
MAX_LOST = 0.5


def occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_words(line: Column) -> Column:
    return F.size(words(line))


def line_fails(line: Column) -> Column:
    """Punctuation (symbols, shouting, no sentence end in a long line), navigation and boilerplate.

    Patterns that end at the first character they look for come before those that read the whole line.
    """
    n = line_words(line)
    shouted = ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}") & (n >= MAX_SHOUTED_WORDS)
    unended = ~line.rlike(SENTENCE_END) & (n > MAX_UNENDED_WORDS)
    marked = line.rlike(SYMBOL) & (occurrences(line, SYMBOL) > n * MAX_SYMBOLS_PER_WORD)
    links = line.rlike(SEPARATOR) & (occurrences(line, SEPARATOR) >= MIN_SEPARATORS)
    return shouted | unended | marked | links | line.rlike(NAVIGATION) | line.rlike(BOILERPLATE)


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows that occur more than once, from the hash of each window in order of its place."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(placed)


def measured(rows: DataFrame) -> DataFrame:
    """Rows with a column `doc` gain n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and `lines`."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    split = rows.select(
        "doc",
        F.transform(words(text), lambda w: F.xxhash64(w)).alias("ids"),
        F.split(text, "\n").alias("lines"),
        (F.length(text) - occurrences(text, SPACE)).cast("bigint").alias("word_chars"),
        occurrences(text, SYMBOL).cast("bigint").alias("n_symbols"),
    )
    n = F.size("ids")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = split.select(
        "doc", "lines", "word_chars", "n_symbols",
        n.cast("bigint").alias("n_words"),
        F.transform(starts, lambda i: F.xxhash64(*[F.get("ids", i + k) for k in range(WINDOW)])).alias("hashes"),
        F.filter("lines", lambda line: line.rlike(WORD)).alias("filled"),
    )
    placed = windows.select(
        "doc", "lines", "word_chars", "n_symbols", "n_words",
        (F.size("filled") - F.size(F.array_distinct("filled"))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("hashes")).alias("placed"),
    )
    twice = F.filter(
        "placed",
        lambda x, i: (F.get("placed", i - 1)["h"] == x["h"]) | F.coalesce(F.get("placed", i + 1)["h"] == x["h"], F.lit(False)),
    )
    found = placed.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("placed")
    step = F.transform("at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW))))
    return found.withColumn(
        "n_repeat_words", F.aggregate(step, F.lit(0).cast("bigint"), lambda a, x: a + x)
    ).drop("at")


def judged(rows: DataFrame) -> DataFrame:
    """Rows with a column `doc` gain the measures, base_failed, kept and `clean_text` (the lines that passed)."""
    n, lost = F.col("n_words"), F.col("lost_words")
    passed = measured(rows).withColumn("passed", F.filter("lines", lambda line: ~line_fails(line)))
    counted = passed.withColumn(
        "lost_words",
        n - F.aggregate(F.transform("passed", line_words), F.lit(0).cast("bigint"), lambda a, x: a + x),
    )
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return counted.select(
        "doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words",
        base.alias("base_failed"),
        (~base & (lost <= n * MAX_LOST)).alias("kept"),
        F.array_join("passed", "\n").alias("clean_text"),
    )


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id and all measures and verdicts."""
    report = judged(as_rows(docs))
    return report.select("doc.doc_id", *[c for c in report.columns if c not in ("doc", "clean_text")])


def clean_documents(docs: DataFrame) -> DataFrame:
    """The kept rows with their passed lines as text (n_chars follows the text); columns as in docs."""
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("bigint")}
    cleaned = judged(as_rows(docs)).select(
        "kept", F.struct(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]).alias("doc")
    )
    # Written before the verdict filters: a filter on it would be moved below the steps and repeat all their expressions.
    return stored(cleaned, "rules").filter("kept").select("doc.*")
