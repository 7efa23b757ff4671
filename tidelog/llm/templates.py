"""Line dedup by a tree of line templates.

A line goes down a tree of fixed depth: its number of tokens, then its first LEADING tokens, then one of two leaves that
keep every other of the tokens that follow and hold `<*>` in place of the rest; tokens with a digit are `<*>` from the
start. So lines that differ in numbers, or in fields all at even or all at odd places, share a template. Lines of fewer
than MIN_HALVED tokens keep all of theirs.

A template recurs if it is in documents of MIN_DOCUMENTS classes or more, where a document and all its near copies (see
`near`) are one class: lines that documents share because they are copies of each other stay, and what stands around a
line doesn't matter. Lines of recurring templates are dropped. Classes are those of the documents that hold any frequent
template (one in MIN_DOCUMENTS documents or more, not all of one text): a document without one links no others.

The first pass over lines is stored as template and class of text; documents are
counted per template, pre-aggregated before the shuffle, so a line in a third of all documents costs a row per task. Only
frequent templates are then counted by class, dealt by template and class. Both they and the recurring ones are measured: below
BROADCAST_TEMPLATES their hashes go to every task and documents aren't shuffled for them; beyond that documents are joined
with them. Both ways give the same rows.

Defined cases: a null text has no lines; lines without a word are no lines of their own but stay where they are; a very long
text is worked through line by line; a line that repeats in one document counts once; rows that repeat are documents of
their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import as_rows, in_python, settled, small, stored
from tidelog.llm.near import near_classes, text_class

# Production parameters.
LEADING = 2
MIN_HALVED = 8
MIN_DOCUMENTS = 8
BROADCAST_TEMPLATES = 4_000_000  # 8 bytes each

_DIGIT = re.compile(rb"\d")
_ANY = b"<*>"
_BATCH = 1 << 16
_AT_ONCE = 1024  # rows that a task cuts at a time


def line_templates(line: bytes) -> tuple[int, ...]:
    """The hashes of a line's templates: two, or one for a short line, or none for a line without a word."""
    tokens = line.split()
    if not tokens:
        return ()
    if _DIGIT.search(line):
        tokens = [_ANY if _DIGIT.search(t) else t for t in tokens]
    if len(tokens) < MIN_HALVED:
        return (_hash(b" ".join(tokens)),)
    head = b"%d %s " % (len(tokens), b" ".join(tokens[:LEADING]))
    return (
        _hash(head + b" ".join(tokens[LEADING::2])),
        _hash(head + _ANY + b" " + b" ".join(tokens[LEADING + 1 :: 2])),
    )


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) - (1 << 63)


def _lines(text: bytes) -> list[tuple[int, ...]]:
    return [t for t in map(line_templates, text.split(b"\n")) if t]


def _seen(batches):
    """Per document and template that it has: the template and the class of the text."""
    found, classes = [], []
    for batch in batches:
        for text, class_ in zip(batch.column("text").cast(pa.binary()), batch.column("class").to_pylist()):
            own = {t for templates in _lines(text.as_py() or b"") for t in templates}
            found.extend(own)
            classes.extend([class_] * len(own))
            if len(found) > _BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(classes, pa.int64())], ["template", "class"])
                found, classes = [], []
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(classes, pa.int64())], ["template", "class"])


def _known(templates: DataFrame, limit: int):
    """The templates (a stored table) as a broadcast sorted array, or None if they are more than the limit."""
    if templates.count() > limit:
        return None
    found = templates.toArrow().column(0).to_numpy()  # limit numbers at most
    return templates.sparkSession.sparkContext.broadcast(np.sort(found))


def _among(known: np.ndarray, templates: list[int]) -> set[int]:
    """Those of the templates that are known. A set of all the known ones would be many times their array, in each worker."""
    own = np.array(templates, np.int64)
    if not len(known) or not len(own):
        return set()
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return set(own[known[at] == own].tolist())


def _holding(known):
    """The texts that hold a known template."""

    def holding(batches):
        for batch in batches:
            texts = (t.as_py() or b"" for t in batch.column("text").cast(pa.binary()))
            yield batch.filter(pa.array([bool(_among(known.value, [t for ts in _lines(x) for t in ts])) for x in texts], pa.bool_()))

    return holding


def recurring_templates(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, limit: int = BROADCAST_TEMPLATES) -> DataFrame:
    """(template): hashes of the templates whose lines are dropped."""
    texts = docs.select("text", text_class(F.col("text")).alias("class"))

    def frequent_pairs() -> DataFrame:
        seen = stored(in_python(texts, _seen, "template bigint, class bigint"), "line-seen")
        counts = seen.groupBy("template").agg(F.count("*").alias("n"), F.min("class").alias("a"), F.max("class").alias("b"))
        often = counts.filter((F.col("n") >= min_documents) & ((F.col("a") != F.col("b")) | F.lit(min_documents <= 1)))
        often = stored(often.select("template"), "line-often")
        return seen.join(F.broadcast(often) if small(often, 32) else often, "template", "left_semi").distinct()

    pairs = settled(frequent_pairs, "line-pairs")
    frequent = stored(pairs.select("template").distinct(), "line-frequent")
    known = _known(frequent, limit)
    if known is not None:
        held = in_python(texts, _holding(known), "text string, class bigint")
    else:
        held = texts.join(pairs.select("class").distinct(), "class", "left_semi")
    classes = settled(lambda: near_classes(stored(held, "line-held")), "line-classes")
    pairs = pairs.join(classes, F.col("class") == F.col("node"), "left")
    pairs = pairs.select("template", F.coalesce("root", "class").alias("class")).distinct()
    return pairs.groupBy("template").count().filter(F.col("count") >= min_documents).select("template")


def cut_lines(text: bytes, drops_of) -> tuple[bytes, int, int]:
    """The text without its dropped lines, its number of lines, and how many were dropped.

    `drops_of` gets the templates of all lines and gives those whose lines are dropped.
    """
    lines = text.split(b"\n")
    templates = [line_templates(line) for line in lines]
    drops = drops_of([t for ts in templates for t in ts])
    kept = [line for line, ts in zip(lines, templates) if drops.isdisjoint(ts)]
    return b"\n".join(kept), sum(map(bool, templates)), len(lines) - len(kept)


def _result(batch: pa.RecordBatch, texts: list, with_rows: bool) -> pa.RecordBatch:
    kept, n, removed = zip(*texts) if texts else ((), (), ())
    numbers = [pa.array(n, pa.int64()), pa.array(removed, pa.int64())]
    if with_rows:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(kept, pa.binary()).cast(pa.string()), *numbers], ["doc", "kept_text", "n_lines", "n_removed"]
        )
    sha = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
    return pa.RecordBatch.from_arrays([batch.column("doc"), sha, *numbers], ["doc", "kept_sha256", "n_lines", "n_removed"])


def _few(batches, with_rows: bool):
    """The batches in slices, with their texts, which whole rows hold already."""
    for batch in batches:
        for at in range(0, batch.num_rows, _AT_ONCE):
            part = batch.slice(at, _AT_ONCE)
            text = part.column("doc").field("text") if with_rows else part.column("text")
            yield part, text.cast(pa.binary())


def _cut_broadcast(recurring, with_rows: bool):
    def cut(batches):
        for batch, texts in _few(batches, with_rows):
            yield _result(batch, [cut_lines(t.as_py() or b"", lambda ts: _among(recurring.value, ts)) for t in texts], with_rows)

    return cut


def _cut_listed(with_rows: bool):
    def cut(batches):
        for batch, texts in _few(batches, with_rows):
            out = []
            for text, listed in zip(texts, batch.column("drops")):
                own = set(listed.as_py() or ())
                out.append(cut_lines(text.as_py() or b"", lambda ts: own))
            yield _result(batch, out, with_rows)

    return cut


def _held(batches):
    """Per document the templates that it has."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        lists = [list({x for ts in _lines(t.as_py() or b"") for x in ts}) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("row_id"), pa.array(lists, pa.list_(pa.int64()))], ["row_id", "held"])


def _cut_rows(docs: DataFrame, with_rows: bool, min_documents: int, limit: int) -> DataFrame:
    recurring = settled(lambda: recurring_templates(docs, min_documents, limit), "line-templates")
    rows = as_rows(docs if with_rows else docs.select("doc_id", "text"))
    text = F.col("doc.text").alias("text")
    kept = "kept_text" if with_rows else "kept_sha256"
    carried = F.col("doc") if with_rows else F.struct("doc.doc_id").alias("doc")
    kind = rows.select(carried).schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, {kept} string, n_lines bigint, n_removed bigint"
    needed = [carried] if with_rows else [carried, text]
    known = _known(recurring, limit)
    if known is not None:
        return in_python(rows.select(*needed), _cut_broadcast(known, with_rows), schema)
    # A row's identity: equal rows have equal texts and so the same drops.
    identity = F.sha2(F.coalesce(F.col("doc.text"), F.lit("")), 256).alias("row_id")
    held = in_python(rows.select(identity, text).dropDuplicates(["row_id"]), _held, "row_id string, held array<bigint>")
    drops = held.select("row_id", F.explode("held").alias("template")).join(recurring, "template", "left_semi")
    drops = drops.groupBy("row_id").agg(F.collect_list("template").alias("drops"))  # a text's own templates
    listed = rows.select(*needed, identity).join(drops, "row_id", "left").drop("row_id")
    return in_python(listed, _cut_listed(with_rows), schema)


def line_dedup_report(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, limit: int = BROADCAST_TEMPLATES) -> DataFrame:
    """Per row of docs: doc_id, n_lines (with a word), n_removed, kept_sha256 (of the text that is left, in UTF-8)."""
    return _cut_rows(docs, False, min_documents, limit).select("doc.doc_id", "n_lines", "n_removed", "kept_sha256")


def without_recurring_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, limit: int = BROADCAST_TEMPLATES) -> DataFrame:
    """The rows of docs without their recurring lines; n_chars follows the text, and a null text stays null."""
    cut = _cut_rows(docs, True, min_documents, limit)
    text = F.when(F.col("doc.text").isNotNull(), F.col("kept_text"))
    new = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None}
    return cut.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
