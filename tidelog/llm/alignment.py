"""Alignment of two tokenizers over one text, by merge-path partitioning.

The ends of the A and the B tokens, as byte offsets, are two sorted lists. Each segment between neighbouring ends of the
merged list lies in exactly one token of either side: that is a link. An end that both lists hold closes a group. The merge
is cut into pieces of equal work: a binary search along a diagonal (i + j = d) finds where the merge of both lists stands
after d ends, so that every piece is merged by itself. An end that its twin in the piece before has told already is
dropped when the pieces are put together, and groups that reach over a border are numbered through.

Texts are merged in lots of some megabytes, one after another in one byte range, so a lot's pieces are the same size
whatever the texts are. Very long texts go through several lots, cut where both tokenizers start anew: before a blank with
no other white space beside it. Chunks between such blanks are encoded once per lot and remembered for a while.

How often an id pair is linked is counted per task in batches of documents; a batch keeps its documents' links as
numbers into its list of distinct pairs. Only that list meets the corpus-wide counts (in a join), and comes back as one row
per batch.

Defined cases: texts that are null or empty, or whose tokens don't give back their bytes, have no tokens and all counts 0;
rows that repeat count as often as they occur; a null doc_id stays null; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import in_python, stored

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
PIECE = 1 << 16  # ends of a piece of the merge
LOT_CHARS = 2_000_000  # of texts that are merged together
BATCH_LINKS = 2_000_000  # different links of documents whose pair counts come back together
KNOWN_CHUNKS = 200_000  # per worker; forgotten at once beyond that

_ID_BITS = 20  # of a token id within a link's number
_BESIDE = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WORDS_AT_ONCE = 20_000


def byte_alphabet() -> dict[str, int]:
    """Of byte-level vocabularies: printable Latin-1 characters are themselves, all other bytes count up from U+0100."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """One tokenizer: ids of a text, and the bytes of each id."""

    def __init__(self, ids, pieces: list[bytes]):
        self.ids = ids
        self.pieces = pieces
        self.size = np.array([len(p) for p in pieces], np.int64)
        numbers = [str(i) for i in range(len(pieces))]
        self.inner = np.array([n + "," for n in numbers], object)
        self.last = numbers


@lru_cache(1)
def sides(name_a: str, name_b: str) -> tuple[Side, Side]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path(name_a))
    a.encode_special_tokens = True
    letters = byte_alphabet()
    pieces = [a.id_to_token(i) for i in range(a.get_vocab_size())]
    special = {i for i, token in a.get_added_tokens_decoder().items() if token.special}
    a_bytes = [p.encode() if i in special else bytes(letters[c] for c in p) for i, p in enumerate(pieces)]

    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name_b))
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())

    def a_ids(text: str) -> list[int]:
        return a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids

    left, right = Side(a_ids, a_bytes), Side(b.encode, b_bytes)
    left.last = np.array([n + "|" for n in left.last], object)
    right.last = np.array([n + ";" for n in right.last], object)
    return left, right


def diagonals(a_ends: np.ndarray, b_ends: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of both lists stands after 0, piece, 2 * piece, ... ends: how many of A and of B are in. A first."""
    n_a, n_b = len(a_ends), len(b_ends)
    d = np.append(np.arange(0, n_a + n_b, piece), n_a + n_b)
    low, high = np.maximum(d - n_b, 0), np.minimum(d, n_a)
    if not n_a or not n_b:
        return low, d - low
    while np.any(open_ := low < high):
        middle = (low + high) // 2
        # More of A is in as long as A's next end is not above the last of B's that would be in.
        more = a_ends[np.minimum(middle, n_a - 1)] <= b_ends[np.clip(d - middle - 1, 0, n_b - 1)]
        low = np.where(open_ & more, middle + 1, low)
        high = np.where(open_ & ~more, middle, high)
    return low, d - low


def merged(a_ends: np.ndarray, b_ends: np.ndarray, piece: int = PIECE):
    """Piece by piece: the links' A and B token numbers, which of the piece's A and B ends close a group, and its range."""
    i_at, j_at = diagonals(a_ends, b_ends, piece)
    for i0, i1, j0, j1 in zip(i_at[:-1], i_at[1:], j_at[:-1], j_at[1:]):
        a, b = a_ends[i0:i1], b_ends[j0:j1]
        # An A end lies in the first B token that ends there or later, maybe the first of the next piece.
        in_b = j0 + np.searchsorted(b, a)
        a_cut = b_ends[np.minimum(in_b, len(b_ends) - 1)] == a
        in_a = i0 + np.searchsorted(a, b)
        # The twin of a B end is in this piece, or was the last A end of the piece before.
        b_cut = np.zeros(len(b), bool)
        here = in_a < i1
        b_cut[here] = a_ends[in_a[here]] == b[here]
        if i0 and len(b):
            b_cut[0] |= a_ends[i0 - 1] == b[0]
        alone = ~b_cut
        links_a = np.concatenate([np.arange(i0, i1), in_a[alone]])
        links_b = np.concatenate([in_b, np.arange(j0, j1)[alone]])
        yield links_a, links_b, a_cut, b_cut, (i0, i1, j0, j1)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


class Chunks:
    """Chunks of text that were met lately, with their tokens on either side."""

    def __init__(self, names: tuple[str, str]):
        self.sides = sides(*names)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.known = []  # per chunk: do both sides give back its bytes
        self.tokens = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.starts = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.counts = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def _add(self, per_side: list[tuple[np.ndarray, np.ndarray]], good: list[bool]) -> None:
        for s, (ids, counts) in enumerate(per_side):
            first = len(self.tokens[s])
            self.tokens[s] = np.concatenate([self.tokens[s], ids])
            self.starts[s] = np.concatenate([self.starts[s], first + np.cumsum(counts) - counts])
            self.counts[s] = np.concatenate([self.counts[s], counts])
        self.known += good

    def _encode_together(self, chunks: list[str]) -> bool:
        text = " ".join(chunks)
        raw = (" " + text).encode()
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        found = []
        for side in self.sides:
            ids = side.ids(text)
            if b"".join([side.pieces[i] for i in ids]) != raw:
                return False
            ids = np.array(ids, np.int64)
            token_ends = np.cumsum(side.size[ids])
            upto = np.searchsorted(token_ends, ends)
            if not np.array_equal(token_ends[upto], ends):
                return False
            found.append((ids, np.diff(upto + 1, prepend=0)))
        self._add(found, [True] * len(chunks))
        return True

    def _encode_alone(self, chunks: list[str]) -> None:
        found, good = [[], []], []
        for chunk in chunks:
            raw, whole = (" " + chunk).encode(), True
            for side, ids in zip(self.sides, found):
                ids.append(side.ids(chunk))
                whole &= b"".join([side.pieces[i] for i in ids[-1]]) == raw
            good.append(whole)
        counts = [np.array([len(x) for x in ids], np.int64) for ids in found]
        self._add([(np.array([i for x in ids for i in x], np.int64), n) for ids, n in zip(found, counts)], good)

    def learn(self, chunks: list[str]) -> None:
        """Encode what is new, many at once where blanks may join them."""
        plain, odd = [], []
        for chunk in dict.fromkeys(chunks):
            if chunk not in self.number:
                whole = chunk and not chunk[0].isspace() and not chunk[-1].isspace() and "▁" not in chunk
                (plain if whole else odd).append(chunk)
        for i in range(0, len(plain), _WORDS_AT_ONCE):
            lot = plain[i : i + _WORDS_AT_ONCE]
            start = len(self.known)
            if self._encode_together(lot):
                self.number.update(zip(lot, range(start, start + len(lot))))
            else:
                odd += lot
        if odd:
            self.number.update(zip(odd, range(len(self.known), len(self.known) + len(odd))))
            self._encode_alone(odd)

    def of(self, numbers: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of these chunks on one side, and each chunk's count."""
        counts = self.counts[s][numbers]
        return self.tokens[s][_spread(self.starts[s][numbers], counts)], counts


def chunks_of(text: str) -> list[str]:
    """The parts of a text between blanks that no other white space touches."""
    if text[:1].isspace() or text[-1:].isspace() or _BESIDE.search(text):
        return _CUT.split(text)
    return text.split(" ")


def segments(text: str, at_most: int = LOT_CHARS):
    """A long text in parts, cut where chunks are; the blanks between them are left out."""
    start = 0
    while len(text) - start > at_most:
        cut = _CUT.search(text, start + at_most)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


class Batch:
    """Documents whose links are numbered together."""

    def __init__(self, names: tuple[str, str], piece: int):
        self.chunks, self.piece = Chunks(names), piece
        self.clear()

    def clear(self) -> None:
        self.ids, self.sums, self.shas, self.bad = [], [], [], set()
        self.lot, self.lot_chars = [], 0  # (document's place, text)
        self.links = []  # (place << 2 * _ID_BITS | a << _ID_BITS | b, how many)
        self.n_links = 0

    def add(self, doc_id, text: str | None) -> None:
        place = len(self.ids)
        self.ids.append(doc_id)
        self.sums.append(np.zeros(4, np.int64))
        self.shas.append(None)
        for part in segments(text) if text else ():
            self.lot.append((place, part))
            self.lot_chars += len(part)
            if self.lot_chars >= LOT_CHARS:
                self.align()

    def align(self) -> None:
        """Merge the lot's texts, add up what their documents have, and keep their links."""
        lot, self.lot, self.lot_chars = self.lot, [], 0
        parts = [(place, chunks_of(text)) for place, text in lot]
        words = [c for _, chunks in parts for c in chunks]
        if len(self.chunks.known) > KNOWN_CHUNKS:
            self.chunks.forget()
        self.chunks.learn(words)
        numbers = np.fromiter(map(self.chunks.number.__getitem__, words), np.int64, len(words))
        places = np.repeat([place for place, _ in parts], [len(chunks) for _, chunks in parts])
        good = np.array(self.chunks.known)[numbers] if len(words) else np.empty(0, bool)
        self.bad.update(places[~good].tolist())
        if self.bad:
            kept = ~np.isin(places, list(self.bad))
            numbers, places = numbers[kept], places[kept]
        if not len(numbers):
            return
        left, right = self.chunks.sides
        (a, a_counts), (b, b_counts) = self.chunks.of(numbers, 0), self.chunks.of(numbers, 1)
        a_place, b_place = np.repeat(places, a_counts), np.repeat(places, b_counts)
        a_ends, b_ends = np.cumsum(left.size[a]), np.cumsum(right.size[b])
        a_cut, b_cut, found = np.empty(len(a), bool), np.empty(len(b), bool), []
        for links_a, links_b, cut_a, cut_b, (i0, i1, j0, j1) in merged(a_ends, b_ends, self.piece):
            a_cut[i0:i1], b_cut[j0:j1] = cut_a, cut_b
            found.append((a_place[links_a] << 2 * _ID_BITS) | (a[links_a] << _ID_BITS) | b[links_b])
        found = np.concatenate(found)
        first, last = int(places[0]), int(places[-1])
        per_place = [a_place, b_place, a_place[a_cut], found >> 2 * _ID_BITS]
        sums = np.stack([np.bincount(p - first, minlength=last - first + 1) for p in per_place], axis=1)
        for k, row in enumerate(sums):
            self.sums[first + k] += row
        links, n = np.unique(found, return_counts=True)
        self.links.append((links, n))
        self.n_links += len(links)
        self._write_groups(a, b, a_cut, b_cut, a_place, b_place)

    def _write_groups(self, a, b, a_cut, b_cut, a_place, b_place) -> None:
        """Add the groups, as text, to each document's hash: a group's A ids and then its B ids."""
        left, right = self.chunks.sides
        b_upto = np.flatnonzero(b_cut) + 1
        a_upto = np.flatnonzero(a_cut) + 1
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        text = np.empty(len(a) + len(b), object)
        text[np.arange(len(a)) + np.append(0, b_upto)[a_group]] = np.where(a_cut, left.last[a], left.inner[a])
        text[np.arange(len(b)) + a_upto[b_group]] = np.where(b_cut, right.last[b], right.inner[b])
        found, a_first = np.unique(a_place, return_index=True)
        starts = np.append(a_first + np.searchsorted(b_place, found), len(text))
        for place, start, end in zip(found.tolist(), starts[:-1].tolist(), starts[1:].tolist()):
            sha = self.shas[place]
            if sha is None:
                sha = self.shas[place] = sha256()
            else:
                sha.update(b";")
            sha.update("".join(text[start:end].tolist())[:-1].encode())

    def row(self, number: int) -> dict:
        """The batch as one row of the written table."""
        if self.lot:
            self.align()
        links = np.concatenate([x for x, _ in self.links]) if self.links else np.empty(0, np.int64)
        n = np.concatenate([x for _, x in self.links]) if self.links else np.empty(0, np.int64)
        places = links >> 2 * _ID_BITS
        if self.bad:
            kept = ~np.isin(places, list(self.bad))
            links, n, places = links[kept], n[kept], places[kept]
        pairs, at = np.unique(links & ((1 << 2 * _ID_BITS) - 1), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, at, n)
        sums = np.array(self.sums, np.int64).reshape(-1, 4)
        if self.bad:
            sums[list(self.bad)] = 0
        shas = [s.hexdigest() if s and i not in self.bad else "" for i, s in enumerate(self.shas)]
        row = {
            "batch": number, "a": pairs >> _ID_BITS, "b": pairs & ((1 << _ID_BITS) - 1), "n": total,
            "doc_id": self.ids, "n_a": sums[:, 0], "n_b": sums[:, 1], "n_groups": sums[:, 2], "n_links": sums[:, 3],
            "groups_sha256": shas, "places": np.bincount(places, minlength=len(self.ids)),
            "links": zlib.compress(at.astype("<u4").tobytes(), 1), "times": zlib.compress(n.astype("<u4").tobytes(), 1),
        }
        self.clear()
        return row


_ROW = pa.schema(
    [("batch", pa.int64()), *[(c, pa.list_(pa.int64())) for c in ("a", "b", "n", "doc_id", "n_a", "n_b", "n_groups", "n_links")]]
    + [("groups_sha256", pa.list_(pa.string())), ("places", pa.list_(pa.int64())), ("links", pa.binary()), ("times", pa.binary())]
)
_ROW_DDL = (
    "batch bigint, a array<bigint>, b array<bigint>, n array<bigint>, doc_id array<bigint>, n_a array<bigint>, "
    "n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, places array<bigint>, "
    "links binary, times binary"
)


def _as_batch(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _ROW], schema=_ROW)


def _aligner(names: tuple[str, str], piece: int, batch_links: int):
    def align(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        batch = Batch(names, piece)
        for rows in batches:
            for doc_id, text in zip(rows.column(0), rows.column(1)):
                batch.add(doc_id.as_py(), text.as_py())
                if batch.n_links >= batch_links or len(batch.ids) >= batch_links:
                    yield _as_batch(batch.row(number))
                    number += 1
        if batch.ids:
            yield _as_batch(batch.row(number))

    return align


_OUT = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)


def _summed(batches):
    """Batches with the counts of their pairs (in the pairs' order) to one row per document."""
    for rows in batches:
        for i in range(rows.num_rows):
            row = {name: rows.column(name)[i] for name in rows.schema.names}
            docs = len(row["doc_id"])
            at = np.frombuffer(zlib.decompress(row["links"].as_py()), "<u4")
            n = np.frombuffer(zlib.decompress(row["times"].as_py()), "<u4").astype(np.int64)
            best, sums = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
            if len(at):
                counts = row["counts"].values
                count = counts.field("count").to_numpy(zero_copy_only=False)
                is_best = counts.field("best").to_numpy(zero_copy_only=False)
                place = np.repeat(np.arange(docs), row["places"].values.to_numpy())
                np.add.at(sums, place, n * count[at])
                np.add.at(best, place, n * is_best[at])
            kept = {c: row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            kept |= {"n_best": pa.array(best), "count_sum": pa.array(sums)}
            yield pa.RecordBatch.from_arrays([kept[f.name] for f in _OUT], schema=_OUT)


def pair_counts(batches: DataFrame) -> DataFrame:
    """(a, b, count, best): how many links hold each id pair, and whether no pair of its B id has more."""
    pairs = batches.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts = stored(counts, "alignment-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment_report(
    docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, piece: int = PIECE,
    batch_links: int = BATCH_LINKS,
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    batches = stored(in_python(texts, _aligner((tokenizer_a, tokenizer_b), piece, batch_links), _ROW_DDL), "alignment")
    listed = batches.select("batch", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("batch", "at", "p.a", "p.b")
    told = listed.join(pair_counts(batches), ["a", "b"])
    told = told.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("counts"))
    whole = batches.drop("a", "b", "n").join(told, "batch", "left")
    columns = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'bigint'}" for f in _OUT)
    return in_python(whole, _summed, columns)
