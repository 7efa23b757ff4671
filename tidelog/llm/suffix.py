"""Suffix-array dedup: bytes covered by a string of LENGTH bytes that also starts anywhere else.

A suffix array with common-prefix lengths over the whole corpus would be rows of many times its size. So the corpus is cut
into shards first such that equal strings meet in one: every string of LENGTH bytes names the rightmost smallest of
its K-byte hashes (its anchor), and successive strings with the same anchor are a run. Only runs whose anchor occurs at
least twice can hold a repeat. Such a run with the bytes of its strings is a context; equal contexts become one, with
their number. Contexts go to shards by anchor.

In a shard suffixes are sorted by induced sorting. The queue of suffix tuples (first byte, length of its run, rank of the
suffix behind) is popped a batch of buckets at a time, namely buckets that don't induce into each other; named
substrings that repeat are sorted by recursion on the shorter string of names. A shard's arrays are files in the task's own
folder when they are larger than IN_MEMORY bytes, and go with the task. Adjacent suffixes are then compared over
LENGTH bytes; a string repeats if a neighbour has it too or its context occurred more than once.

Defined cases: a null text is empty; rows without a doc_id lose nothing and remove nothing; rows that repeat repeat each
other's strings; texts shorter than LENGTH lose nothing; very long texts are worked through in pieces; an empty table gives no
rows. A character whose bytes are cut apart stays cut apart: the result is bytes.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import in_python, stored
from tidelog.llm.hashing import BYTES, MULTIPLIERS, ranges_hash, windows_hash
from tidelog.llm.substring import shared_groups

LENGTH = 200
K = 48
SHARD_BYTES = 1 << 21  # contexts that are sorted together; an anchor's contexts are never parted
IN_MEMORY = 64 << 20
_PIECE = 1 << 20
_ROWS = 1 << 16
_SEPARATOR = 255  # no byte of UTF-8


# Anchors


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window, by minima from both ends of blocks of the width."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(left[:n], right[width - 1 : width - 1 + n])


def runs(text: bytes, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per run: its anchor's hash, its first string and the end of its strings' starts."""
    found = []
    n = len(text) - length + 1
    for at in range(0, max(0, n), _PIECE):
        part = np.frombuffer(text, np.uint8)[at : at + _PIECE + length - 1]
        h = windows_hash(BYTES[part], k, MULTIPLIERS[0])
        place = np.uint64((1 << 24) - 1) - np.arange(len(h), dtype=np.uint64)
        low = np.uint64((1 << 24) - 1)
        smallest = _sliding_min(h & ~low | place, length - k + 1)
        where = (low - (smallest & low)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        ends = np.append(starts[1:], len(where))
        found.append((h[where[starts]].view(np.int64), starts + at, ends + at))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def _anchors(length: int, k: int):
    def anchors(batches):
        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                h, starts, _ = runs(text.as_py(), length, k)
                held.append((h, np.full(len(h), doc_id, np.int64), starts))
                size += len(h)
                if size > _ROWS:
                    yield _anchor_batch(held)
                    held, size = [], 0
        yield _anchor_batch(held)

    return anchors


def _anchor_batch(held) -> pa.RecordBatch:
    h, doc, at = (np.concatenate(x) for x in zip(*held)) if held else (np.empty(0, np.int64),) * 3
    return pa.RecordBatch.from_arrays([pa.array(h), pa.array(doc), pa.array(at.astype(np.int32))], ["h", "doc", "at"])


def _contexts(length: int, k: int, with_bytes: bool):
    """Per run of a document that starts at one of its listed places: anchor, context's hash, document, place, bytes."""

    def contexts(batches):
        for batch in batches:
            columns, size = [[] for _ in range(6)], 0
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                text = batch.column("text").cast(pa.binary())[i].as_py()
                h, starts, ends = runs(text, length, k)
                keep = np.isin(starts, batch.column("places")[i].values.to_numpy())
                h, starts, ends = h[keep], starts[keep], ends[keep] + length - 1
                data = BYTES[np.frombuffer(text, np.uint8)]
                h1, h2 = (ranges_hash(data, starts, ends, m).view(np.int64) for m in MULTIPLIERS[:2])
                own = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())] if with_bytes else []
                for column, values in zip(columns, (h, h1, h2, np.full(len(h), doc_id), starts, own)):
                    column.append(values)
                size += len(h)
                if size > _ROWS // 8:
                    yield _context_batch(columns, with_bytes)
                    columns, size = [[] for _ in range(6)], 0
            if size:
                yield _context_batch(columns, with_bytes)

    return contexts


def _context_batch(columns, with_bytes: bool) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(c), pa.int64()) for c in columns[:5]]
    names = ["h", "h1", "h2", "doc", "at"]
    if with_bytes:
        return pa.RecordBatch.from_arrays(arrays[:3] + [pa.array([b for own in columns[5] for b in own], pa.binary())], [*names[:3], "bytes"])
    return pa.RecordBatch.from_arrays(arrays, names)


# Induced sorting


class _Scratch:
    """Arrays in memory, or in files of the task's own folder where they are large."""

    def __init__(self, limit: int = IN_MEMORY):
        self.limit, self.folder = limit, None

    def array(self, n: int) -> np.ndarray:
        if 8 * n <= self.limit:
            return np.empty(n, np.int64)
        self.folder = self.folder or tempfile.TemporaryDirectory(prefix="suffixes-")
        with tempfile.NamedTemporaryFile(dir=self.folder.name, delete=False) as file:
            return np.memmap(file.name, np.int64, "w+", shape=(n,))

    def close(self):
        if self.folder:
            self.folder.cleanup()


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a suffix is smaller than the next (S), and how many equal letters follow its first."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], True)
    # The next place whose letter differs from its follower's.
    turn = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = text[turn[:-1]] < text[np.minimum(turn[:-1] + 1, n - 1)]
    small[n - 1] = True
    return small, turn - np.arange(n)


def _batches(depends: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of buckets, ascending, in which none depends on another; depends[a] is the first bucket that a induces into."""
    found, first, least = [], 0, len(depends)
    for a, d in enumerate(depends.tolist()):
        if a >= least:
            found.append((first, a))
            first, least = a, len(depends)
        least = min(least, d)
    found.append((first, len(depends)))
    return found


def _induced(text: np.ndarray, lms: np.ndarray, small: np.ndarray, run: np.ndarray, scratch: _Scratch) -> np.ndarray:
    """The suffix array, from the LMS suffixes in order: large suffixes by the ranks behind them, then small ones."""
    n, letters = len(text), int(text.max()) + 1
    by_letter = np.argsort(text, kind="stable")
    sizes = np.bincount(text, minlength=letters)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    rank = scratch.array(n)
    # LMS suffixes stand at the ends of their buckets for now.
    own = text[lms]
    order = np.argsort(own, kind="stable")
    per = np.bincount(own, minlength=letters)
    within = np.arange(len(lms)) - np.repeat(np.cumsum(per) - per, per)
    rank[lms[order]] = begins[own[order] + 1] - per[own[order]] + within
    behind = np.minimum(np.arange(n) + run + 1, n - 1)
    direct = np.arange(n - 1)[text[:-1] != text[1:]]
    for large in (True, False):
        rows = direct[~small[direct]] if large else direct[small[direct]]
        if large:
            depends = np.full(letters, letters)
            np.minimum.at(depends, text[rows + 1], text[rows])
            ranges = _batches(depends)
        else:
            # The same from the other end: letters counted from the largest.
            depends = np.full(letters, letters)
            np.minimum.at(depends, letters - 1 - text[rows + 1], letters - 1 - text[rows])
            ranges = [(letters - b, letters - a) for a, b in _batches(depends)]
        for first, end in ranges:
            some = by_letter[begins[first] : begins[end]]
            some = some[~small[some] if large else small[some] & (some != n - 1)]
            if not len(some):
                continue
            letter = text[some]
            runs_ = run[some] if large else -run[some]
            some = some[np.lexsort((rank[behind[some]], runs_, letter))]
            letter = text[some]
            count = np.bincount(letter - first, minlength=end - first)
            within = np.arange(len(some)) - np.repeat(np.cumsum(count) - count, count)
            rank[some] = begins[letter] + within if large else begins[letter + 1] - count[letter - first] + within
    rank[n - 1] = 0
    array = scratch.array(n)
    array[rank] = np.arange(n)
    return array


def suffix_array(text: np.ndarray, scratch: _Scratch) -> np.ndarray:
    """Of a text of numbers from 1 that ends in its only 0."""
    _, text = np.unique(text, return_inverse=True)
    small, run = _types(text)
    is_lms = np.append(False, small[1:] & ~small[:-1])
    lms = np.flatnonzero(is_lms)
    if len(lms) == 0:  # the text is its end only
        return np.arange(len(text))
    sorted_lms = lms
    if len(lms) > 1:
        first = _induced(text, lms, small, run, scratch)
        sorted_lms = first[is_lms[first]]
        # Equal LMS substrings get equal names.
        ends = np.append(lms[1:], len(text) - 1)
        hashed = ranges_hash(BYTES[text & 255] + text.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D), lms, ends + 1, MULTIPLIERS[1])
        slot = np.empty(len(text), np.int64)
        slot[lms] = np.arange(len(lms))
        s = slot[sorted_lms]
        new = np.append(True, (hashed[s][1:] != hashed[s][:-1]) | ((ends - lms)[s][1:] != (ends - lms)[s][:-1]))
        names = np.empty(len(lms), np.int64)
        names[s] = np.cumsum(new) - 1
        if not new.all():
            sorted_lms = lms[suffix_array(names, scratch)]
    return _induced(text, sorted_lms, small, run, scratch)


def repeated_starts(contexts: list[bytes], copies: np.ndarray, length: int = LENGTH, limit: int = IN_MEMORY) -> list[np.ndarray]:
    """Per context the starts of its strings that occur more than once, in it, in another, or as it has copies."""
    scratch = _Scratch(limit)
    try:
        sizes = np.array([len(c) + 1 for c in contexts])
        begins = np.cumsum(sizes) - sizes
        data = np.frombuffer(bytes([_SEPARATOR]).join(contexts) + bytes([_SEPARATOR]), np.uint8)
        array = suffix_array(np.append(data.astype(np.int64) + 1, 0), scratch)
        owner = np.repeat(np.arange(len(contexts)), sizes)
        room = (begins + sizes - 1)[owner] - np.arange(len(data))
        array = array[1:]
        array = array[room[array] >= length]
        words = np.zeros(len(data) + length, np.uint64)
        padded = np.concatenate([data, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
        for i in range(8):
            words |= padded[i : i + len(words)] << np.uint64(8 * i)
        a, b = array[:-1], array[1:]
        alike = np.arange(len(a))
        steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
        for k in steps:
            alike = alike[words[a[alike] + k] == words[b[alike] + k]]
        twice = np.zeros(len(array), bool)
        twice[alike] = True
        twice[alike + 1] = True
        twice |= copies[owner[array]] > 1
        flagged = np.sort(array[twice])
        return [part - begin for part, begin in zip(np.split(flagged, np.searchsorted(flagged, begins[1:])), begins)]
    finally:
        scratch.close()


def _spans(starts: np.ndarray) -> np.ndarray:
    """Starts as ranges: first, end, first, end, ..."""
    if not len(starts):
        return starts
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + 1], axis=1).ravel()


def _sorted_shards(length: int, shard_bytes: int):
    def shards(batches):
        """Rows sorted by anchor; a shard ends between anchors."""
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if size > shard_bytes and row[0] != last:
                    yield _shard_result(held, length)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
                last = row[0]
        if held:
            yield _shard_result(held, length)

    return shards


def _shard_result(held: list[tuple], length: int) -> pa.RecordBatch:
    h, h1, h2, contexts, copies = zip(*held)
    spans = [_spans(s) for s in repeated_starts(list(contexts), np.array(copies), length)]
    rows = [(a, b, c, s) for a, b, c, s in zip(h, h1, h2, spans) if len(s)]
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["h", "h1", "h2", "spans"])


# The corpus


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = K) -> tuple[DataFrame, DataFrame]:
    """The documents with shared anchors (doc_id, text), and (doc, first, end): ranges of starts of repeated strings.

    Here doc_id is a number that no other text has, as `own_numbers` gives it.
    """
    some = docs.select("doc_id", "text").filter("text is not null")
    anchors = in_python(some, _anchors(length, k), "h bigint, doc bigint, at int")
    dealt = anchors.repartitionByRange("h", "doc").sortWithinPartitions("h", "doc")
    places = in_python(dealt, shared_groups(True), "doc bigint, at int").groupBy("doc").agg(F.collect_set("at").alias("places"))
    found = some.join(places, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "places")
    found = stored(found, "suffix-documents")
    keys = ["h", "h1", "h2"]
    wide = in_python(found, _contexts(length, k, True), "h bigint, h1 bigint, h2 bigint, bytes binary")
    distinct = wide.groupBy(*keys).agg(F.first("bytes").alias("bytes"), F.count("*").alias("copies"))
    dealt = distinct.repartition("h").sortWithinPartitions("h").select(*keys, "bytes", "copies")
    spans = stored(in_python(dealt, _sorted_shards(length, SHARD_BYTES), "h bigint, h1 bigint, h2 bigint, spans array<bigint>"), "suffix-spans")
    narrow = in_python(found, _contexts(length, k, False), "h bigint, h1 bigint, h2 bigint, doc bigint, at bigint")
    joined = narrow.join(spans, keys)
    return found, joined.select("doc", F.transform("spans", lambda x: x + F.col("at")).alias("spans"))


def cut_bytes(text: bytes, spans: np.ndarray, length: int = LENGTH) -> tuple[bytes, int, int]:
    """The bytes outside of the strings that start in the spans; how many were removed, in how many runs."""
    inside = np.zeros(len(text) + 1, np.int64)
    np.add.at(inside, spans[::2], 1)
    np.add.at(inside, spans[1::2] + length - 1, -1)
    gone = np.cumsum(inside)[:-1] > 0
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return kept, int(gone.sum()), int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())


def _cut(length: int):
    def cut(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text").cast(pa.binary()), batch.column("spans")):
                flat = spans.values.flatten().to_numpy()
                kept, removed, n = cut_bytes(text.as_py(), flat, length)
                rows.append((hashlib.sha256(text.as_py()).hexdigest(), removed, n, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]], ["cut_id", "whole", "cut", "spans", "cut_sha", "kept_bytes"]
            )

    return cut


def cut_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(cut_id, whole, cut, spans, cut_sha, kept_bytes): the documents that lose bytes; whole is the hash of all their bytes."""
    found, spans = repeated_spans(docs, length)
    listed = spans.groupBy("doc").agg(F.collect_list("spans").alias("spans"))  # a document's own ranges
    joined = found.select("doc_id", "text").join(listed, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "spans")
    return in_python(joined, _cut(length), "cut_id bigint, whole string, cut bigint, spans bigint, cut_sha string, kept_bytes binary")


def own_numbers(docs: DataFrame) -> DataFrame:
    """docs with `_own`: the doc_id where it is a number and of one row only, else a hash of doc_id and text."""
    often = docs.groupBy(F.col("doc_id").alias("_often")).agg(F.count("*").alias("n")).filter("n > 1 and _often is not null")
    often = stored(often.select("_often"), "suffix-repeated")
    number = F.when(F.col("_often").isNull(), F.col("doc_id").try_cast("bigint"))
    own = F.coalesce(number, F.xxhash64(F.col("doc_id"), F.col("text")))
    return docs.join(often, F.col("doc_id") == F.col("_often"), "left").withColumn("_own", own).drop("_often")


def suffix_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes)."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = own_numbers(docs.select("doc_id", "text"))
    all_ = rows.select("doc_id", "_own", F.length(data).cast("bigint").alias("n_bytes"), F.sha2(data, 256).alias("sha"))
    cut = cut_documents(rows.select(F.col("_own").alias("doc_id"), "text"), length).drop("kept_bytes").distinct()
    joined = all_.join(cut, (F.col("_own") == F.col("cut_id")) & (F.col("sha") == F.col("whole")), "left")
    return joined.select(
        "doc_id", "n_bytes", F.coalesce("cut", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("cut_sha", "sha").alias("kept_sha256"),
    )
