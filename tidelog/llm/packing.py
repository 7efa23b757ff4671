"""Packing of tokenized documents into sequences by shortest-pack-first over the histogram of lengths.

Documents are cut into pieces of the sequence length and a rest. Lengths are placed longest first, each into the pattern
of pieces that has most room so far; only pattern counts are kept, so the work depends on the number of lengths (2,048 at
most) and not on the documents. Patterns are then joined back to pieces by a piece's rank among those of its length.

Defined cases: a null text is empty, and an empty document is one piece of its end id; very long texts are many pieces;
rows that repeat are packed each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import in_python, stored

SEQUENCE = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
ROWS_PER_SLICE = 20_000
_CACHED_WORDS = 250_000  # per worker; words of the two latest such lots are known
_CACHED_LENGTH = 64
_BYTES_AT_ONCE = 8 << 20  # of texts whose words are looked up together

# Marks at a word's end are tokens of their own if a Latin letter or a digit stands before them, so only what is before
# them has to be known.
_MARKS = frozenset(b".,;:!?$%&*#|")
_MARKED = re.compile(rb"(.*(?:[a-z0-9]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([.,;:!?$%&*#|]+)", re.DOTALL)


@lru_cache(1)
def _tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name)), [{}, {}]


# A lower-case word of these letters only is one piece for the tokenizer's model, which can then be asked directly.
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
# The model's alphabet: bytes that print stand for themselves, the others for characters from 256 on, in order.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _encoded(tokenizer, words: list[bytes]) -> list[bytes]:
    found, others, model = [], [], tokenizer.model
    for i, word in enumerate(words):
        text = word.decode().lower()
        if _LETTERS.fullmatch(text):
            spelled = text if text.isascii() else text.encode().decode("latin-1").translate(_ALPHABET)
            found.append(array("I", [t.id for t in model.tokenize(spelled)]).tobytes())
        else:
            found.append(b"")
            others.append(i)
    whole = tokenizer.encode_batch_fast([words[i].decode() for i in others], add_special_tokens=False)
    for i, encoding in zip(others, whole):
        found[i] = np.array(encoding.ids, "<u4").tobytes()
    return found


def _known_ids(words: list[bytes], name: str) -> list[bytes]:
    """Per lower-case word its ids as little-endian 32-bit numbers; each word is tokenized once."""
    tokenizer, known = _tokenizer(name)
    if len(known[0]) > _CACHED_WORDS:
        known[:] = [{}, known[0]]
    recent, older = known
    own, marked = {}, {}
    for word in words:
        match = _MARKED.fullmatch(word) if word and word[-1] in _MARKS else None
        parts = match.groups() if match else (word,)
        if match:
            marked[word] = parts
        for part in parts:
            if part not in recent:
                own[part] = older.get(part)
    new = [word for word, ids in own.items() if ids is None]
    own.update(zip(new, _encoded(tokenizer, new)))
    recent.update(own)
    found = [recent[marked[w][0]] + recent[marked[w][1]] if w in marked else recent[w] for w in words]
    for word in new:
        if len(word) > _CACHED_LENGTH:
            del recent[word]
    return found


def token_ids(texts: pa.Array, name: str = TOKENIZER) -> list[np.ndarray]:
    """Per text (none null) its ids.

    The tokenizer lowers case and treats white space as a border and nothing else, so a text's ids are those of its words
    in order, and each distinct word is looked at once. Only the marks of special tokens depend on case; texts with them go
    whole.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = words.flatten().dictionary_encode()
    encoded = _known_ids(coded.dictionary.cast(pa.binary()).to_pylist(), name)
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    table, first = np.frombuffer(b"".join(encoded), "<u4"), np.cumsum(sizes) - sizes
    index = coded.indices.to_numpy()
    counts = sizes[index]
    ends = np.concatenate([[0], np.cumsum(counts)])
    ids = table[np.arange(ends[-1]) + np.repeat(first[index] - ends[:-1], counts)]
    borders = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
    found = [ids[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
    for i in np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)):
        whole = _tokenizer(name)[0].encode(texts[int(i)].as_py(), add_special_tokens=False)
        found[i] = np.array(whole.ids, "<u4")
    return found


def _all_ids(texts: pa.Array, name: str):
    """In groups of about _BYTES_AT_ONCE."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _BYTES_AT_ONCE)))
        yield from token_ids(texts[at:end], name)
        at = end


def _cut(limit: int, name: str):
    def cut(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            row, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(_all_ids(texts, name)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                n = len(ids)
                for at in range(0, n, limit):
                    part = ids[at : at + limit]
                    row.append(i)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    total.append(n)
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *numbers], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return cut


def pieces(docs: DataFrame, limit: int = SEQUENCE, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return in_python(docs.select("doc_id", "text"), _cut(limit, tokenizer), schema)


def shortest_pack_first(histogram: dict[int, int], limit: int = SEQUENCE) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns as (count, lengths) that hold every piece of the histogram once, none longer than limit."""
    open_: dict[int, list[list]] = {}  # room -> [count, lengths]

    def put(count: int, lengths: tuple[int, ...]) -> None:
        if count:
            open_.setdefault(limit - sum(lengths), []).append([count, lengths])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_, default=0)
            if room < length:
                # New sequences take as many pieces of the length as fit.
                fit = limit // length
                put(left // fit, (length,) * fit)
                put(int(left % fit > 0), (length,) * (left % fit))
                break
            count, lengths = open_[room].pop()
            if not open_[room]:
                del open_[room]
            used = min(left, count)
            put(count - used, lengths)
            # A pattern takes as many pieces of the length as it has room for, while there are enough for all its copies.
            times = max(1, min(room // length, left // used))
            put(used, lengths + (length,) * times)
            left -= used * times
    return [(count, lengths) for group in open_.values() for count, lengths in group]


def _slots(patterns, shift: int) -> tuple[np.ndarray, ...]:
    """Per place in a pattern, by length and first rank: key, first sequence, offset."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in sorted(patterns, key=lambda p: (p[1], p[0]), reverse=True):
        offset = 0
        for length in lengths:
            first = ranks.get(length, 0)
            ranks[length] = first + count
            rows.append((length << shift | first, sequence, offset))
            offset += length
        sequence += count
    rows.sort()
    return tuple(np.array(column, np.int64) for column in (zip(*rows) if rows else ((), (), ())))


def _placed(slots, shift: int):
    def place(batches):
        keys, sequences, offsets = slots.value
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            own = batch.column("length").to_numpy() << shift | rank
            at = np.searchsorted(keys, own, "right") - 1
            sequence = sequences[at] + own - keys[at]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(sequence), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])

    return place


def packed(docs: DataFrame, limit: int = SEQUENCE, tokenizer: str = TOKENIZER) -> DataFrame:
    """The pieces with sequence_id and offset."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, limit, tokenizer), "pieces")
    histogram = dict(cut.groupBy("length").count().collect())  # a row per length: limit rows at most
    shift = 44
    slots = spark.sparkContext.broadcast(_slots(shortest_pack_first(histogram, limit), shift))
    # Ranks: a length is cut into slices, and small rows say how many pieces the slices before hold.
    slices = max(1, -(-sum(histogram.values()) // ROWS_PER_SLICE))
    sliced = cut.withColumn("slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slices)))
    counts = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("length").alias("_l"), F.col("slice").alias("_s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    order = Window.partitionBy("length", "slice").orderBy("doc_id", "start", "ids_crc32")
    own = sliced.withColumn("within", F.row_number().over(order) - 1)
    ranked = own.join(starts, (F.col("length") == F.col("_l")) & (F.col("slice") == F.col("_s")))
    ranked = ranked.select(*cut.columns, (F.col("before") + F.col("within")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id bigint, offset bigint"
    return in_python(ranked, _placed(slots, shift), schema)
