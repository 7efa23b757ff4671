"""Substring dedup over words, by difference-cover anchors.

A window is WINDOW consecutive words of one document; a word is removed if a window that covers it has the same words as
one that starts in a document with a smaller doc_id. Hashes of all windows would be a row per word of the corpus.
Instead shorter windows are hashed at the positions that a difference cover names, modulo PERIOD: whatever two places a
match starts at, some offset below PERIOD brings both to cover positions, so any match of WINDOW words shares an aligned
anchor of WINDOW - PERIOD + 1 words. Only the windows around shared anchors are then hashed, with 128 bits, and
compared.

Both comparisons sort by (hash, doc_id) over ranges of both, so a passage in any number of documents is many tasks, and
no pair of documents is ever made. In the first, a group that a range border cuts passes as shared, which costs a few
windows; in the second a group's later part asks whether an earlier range ended in the same group.

Defined cases: null texts have no words; rows without a doc_id lose nothing and remove nothing; rows that repeat a doc_id
are one document's, each cut for itself; very long texts are hashed in pieces; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import in_python, stored
from tidelog.llm.hashing import MULTIPLIERS, windows_hash, word_hashes

WINDOW = 50
# Every difference modulo 31 is one of two cover positions.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
_ROWS = 1 << 17


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def anchor_positions(n_words: int, window: int = WINDOW) -> np.ndarray:
    positions = np.arange(max(0, n_words - (window - PERIOD + 1) + 1))
    return positions[np.isin(positions % PERIOD, COVER)] if n_words >= window else positions[:0]


def _anchors(window: int):
    def anchors(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                words = word_hashes(text.as_py())
                at = anchor_positions(len(words), window)
                if len(at):
                    held.append((windows_hash(words, window - PERIOD + 1, MULTIPLIERS[0])[at], np.full(len(at), doc_id), at))
                    size += len(at)
                if size > _ROWS:
                    yield _anchor_batch(held)
                    held, size = [], 0
        yield _anchor_batch(held)

    return anchors


def _anchor_batch(held: list[tuple]) -> pa.RecordBatch:
    h, doc, at = (np.concatenate(x) for x in zip(*held)) if held else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    return pa.RecordBatch.from_arrays([_signed(h), pa.array(doc), pa.array(at.astype(np.int32))], ["h", "doc", "at"])


def _starts_of_groups(keys: list[np.ndarray]) -> np.ndarray:
    """Where a new group begins in sorted rows; the first row begins one."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def shared_groups(same_document: bool):
    """Of rows sorted by hash and document: those whose hash is in several documents (or in several rows, if the same
    document counts), or in a range's first or last group.
    """

    def shared(batches):
        group, first_doc, sure, waiting = None, None, True, []
        for batch in batches:
            h, doc, at = (batch.column(i).to_numpy() for i in range(3))
            if not len(h):
                continue
            starts = _starts_of_groups([h])
            ends = np.append(starts[1:], len(h))
            several = (ends - starts > 1) if same_document else (doc[starts] != doc[ends - 1])
            firsts, out = doc[starts].copy(), []
            if group == h[0]:  # the group goes on
                firsts[0] = first_doc
                several[0] |= sure or same_document or first_doc != doc[ends[0] - 1]
                if several[0]:
                    out, waiting = waiting, []
            else:
                waiting = []  # the group before had one document only
                several[0] |= group is None  # the range's first group may have begun in the range before
            keep = np.repeat(several, ends - starts)
            out.append((doc[keep], at[keep]))
            if len(starts) > 1:
                waiting = []
            if not several[-1]:
                waiting.append((doc[starts[-1] :], at[starts[-1] :]))
            group, first_doc, sure = h[-1], firsts[-1], bool(several[-1])
            yield _place_batch(out)
        yield _place_batch(waiting)  # the last group may go on in the next range

    return shared


def _place_batch(parts: list[tuple]) -> pa.RecordBatch:
    doc, at = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64), np.empty(0, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at, pa.int32())], ["doc", "at"])


def window_starts(anchors: np.ndarray, n_words: int, window: int = WINDOW) -> np.ndarray:
    """The windows that hold one of the anchors within their first PERIOD offsets."""
    anchors = anchors[anchors < n_words]  # others belong to another row of the same doc_id
    near = np.zeros(n_words + 1, np.int32)
    np.add.at(near, np.maximum(0, anchors - (PERIOD - 1)), 1)
    np.add.at(near, anchors + 1, -1)
    return np.flatnonzero(np.cumsum(near)[: max(0, n_words - window + 1)] > 0)


def _windows(window: int):
    def windows(batches):
        for batch in batches:
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                words = word_hashes(batch.column("text").cast(pa.binary())[i].as_py())
                at = window_starts(batch.column("anchors")[i].values.to_numpy(), len(words), window)
                h1, h2 = (windows_hash(words, window, m)[at] for m in MULTIPLIERS[:2])
                for k in range(0, len(at), _ROWS):
                    part = slice(k, k + _ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [_signed(h1[part]), _signed(h2[part]), pa.array(np.full(len(at[part]), doc_id)), pa.array(at[part].astype(np.int32))],
                        ["h1", "h2", "doc", "at"],
                    )

    return windows


_JUDGED = "kind int, h1 bigint, h2 bigint, doc bigint, at int, part int"
# Kinds of judged rows.
_REPEATED, _OPEN, _LAST = 0, 1, 2


def _judged(batches):
    """Of windows sorted by hash and document: those with a smaller document in their group (repeated); those that are their
    range's first of the first group (open); and the range's last group.
    """
    part = TaskContext.get().partitionId()
    group, smallest, opening, last = None, None, None, None
    for batch in batches:
        h1, h2, doc, at = (batch.column(i).to_numpy() for i in range(4))
        if not len(h1):
            continue
        starts = _starts_of_groups([h1, h2])
        least = doc[starts].copy()
        if group == (h1[0], h2[0]):
            least[0] = smallest
        elif group is None:
            opening = (h1[0], h2[0])
        per_row = np.repeat(least, np.diff(np.append(starts, len(doc))))
        repeated = doc > per_row
        kinds = np.where(repeated, _REPEATED, _OPEN)
        first = (h1 == opening[0]) & (h2 == opening[1])
        keep = repeated | first
        last = group = (h1[-1], h2[-1])
        smallest = least[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds[keep].astype(np.int32)), pa.array(h1[keep]), pa.array(h2[keep]), pa.array(doc[keep]), pa.array(at[keep]), pa.array(np.full(keep.sum(), part, np.int32))],
            ["kind", "h1", "h2", "doc", "at", "part"],
        )
    if last is not None:
        row = [[_LAST], [last[0]], [last[1]], [None], [None], [part]]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["kind", "h1", "h2", "doc", "at", "part"])


def candidates(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, anchors): the documents with shared anchors, and where these are."""
    some = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    anchors = in_python(some, _anchors(window), "h bigint, doc bigint, at int")
    dealt = anchors.repartitionByRange("h", "doc").sortWithinPartitions("h", "doc")
    shared = in_python(dealt, shared_groups(False), "doc bigint, at int")
    places = shared.groupBy("doc").agg(F.collect_set("at").alias("anchors"))  # a document's own positions
    return some.join(places, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "anchors")


def repeated_windows(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, at, h1): the windows, by first word and hash, that repeat one of a smaller document."""
    windows = stored(in_python(found, _windows(window), "h1 bigint, h2 bigint, doc bigint, at int"), "windows")
    dealt = windows.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc")
    judged = stored(in_python(dealt, _judged, _JUDGED), "windows-judged")
    # Two rows of one range at most: its last group, and one document's windows in its first group.
    last = judged.filter(F.col("kind") == _LAST).select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), F.col("part").alias("earlier"))
    goes_on = (F.col("h1") == F.col("l1")) & (F.col("h2") == F.col("l2")) & (F.col("earlier") < F.col("part"))
    opened = judged.filter(F.col("kind") == _OPEN).join(last, goes_on, "left_semi")
    return judged.filter(F.col("kind") == _REPEATED).unionByName(opened).select("doc", "at", "h1")


def cut_words(text: bytes, starts: np.ndarray, window: int = WINDOW) -> tuple[bytes, int, int]:
    """The words outside of the windows, joined by one space; the number of words; how many were removed."""
    words = text.split()
    if not len(starts):
        return b" ".join(words), len(words), 0
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + window, -1)
    gone = np.cumsum(inside)[:-1] > 0
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g]), len(words), int(gone.sum())


def _whole(batches):
    for batch in batches:
        rows = [cut_words(t.as_py() or b"", np.empty(0)) for t in batch.column("text").cast(pa.binary())]
        sha = [hashlib.sha256(r[0]).hexdigest() for r in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([r[1] for r in rows], pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "sha"]
        )


def own_starts(text: bytes, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Of a doc_id's starts (place and 32 bits of the window's hash, packed) those that this text has."""
    words = word_hashes(text)
    at = starts >> 32
    fits = at + window <= len(words)
    at, starts = at[fits], starts[fits]
    if not len(at):
        return at
    h1 = windows_hash(words, window, MULTIPLIERS[0])[at].astype(np.uint64) & np.uint64(0xFFFFFFFF)
    return at[h1 == starts.astype(np.uint64) & np.uint64(0xFFFFFFFF)]


def _cut(window: int):
    def cut(batches):
        for batch in batches:
            rows = []
            for text, starts in zip(batch.column("text").cast(pa.binary()), batch.column("starts")):
                whole = hashlib.sha256(b" ".join(text.as_py().split())).hexdigest()
                own = own_starts(text.as_py(), starts.values.to_numpy(), window)
                kept, _, removed = cut_words(text.as_py(), own, window)
                rows.append((whole, removed, kept))
            whole, removed, kept = zip(*rows) if rows else ((), (), ())
            sha = [hashlib.sha256(k).hexdigest() for k in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(whole, pa.string()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["cut_id", "whole", "cut", "cut_sha", "kept_text"],
            )

    return cut


def cut_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(cut_id, whole, cut, cut_sha, kept_text): the documents that lose words; whole is the hash of all their words."""
    found = stored(candidates(docs, window), "anchored")
    # Rows of one doc_id may have different texts; the hash tells whose a place is.
    packed = F.shiftleft(F.col("at").cast("bigint"), 32).bitwiseOR(F.col("h1").bitwiseAND(F.lit(0xFFFFFFFF)))
    starts = repeated_windows(found, window).groupBy("doc").agg(F.collect_list(packed).alias("starts"))
    joined = found.select("doc_id", "text").join(starts, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "starts")
    return in_python(joined, _cut(window), "cut_id bigint, whole string, cut bigint, cut_sha string, kept_text string")


def substring_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    all_ = in_python(docs.select("doc_id", "text"), _whole, f"doc_id {kind}, n_words bigint, sha string")
    cut = cut_documents(docs, window).select("cut_id", "whole", "cut", "cut_sha").distinct()
    joined = all_.join(cut, (F.col("doc_id") == F.col("cut_id")) & (F.col("sha") == F.col("whole")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("cut", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("cut_sha", "sha").alias("kept_sha256")
    )
