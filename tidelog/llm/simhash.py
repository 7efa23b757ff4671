"""SimHash near-duplicates, found by fuzzy hashing with the binary Golay code.

A fingerprint's 64 bits are three segments. Two fingerprints that differ in at most two bits agree in at least one
segment, and in the next segment they differ in at most two bits. The Golay code (23, 12) gives a segment the indices of
all codewords within distance four (one or six); segments that differ in at most two bits share an index, as the
codeword next to the word between them is within four of both. A key is one segment's value and one index of the next:
35 bits, so buckets stay small. Buckets are joined and their pairs verified by counting differing bits.

Equal fingerprints are one class before all this. A bucket of more than MAX_BUCKET classes isn't paired: its members go
to every point within distance one. Classes that differ in at most two bits meet in such a point, all that meet there are
linked, and at most 65 can meet; so a group of near copies of any size costs 65 rows for each member.

Defined cases: null and blank texts have fingerprint 0 and are linked like any other; texts of fewer than three words are
one shingle; rows that repeat have one component; a null doc_id counts as larger than any; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import in_python, stored
from tidelog.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
MAX_BUCKET = 64
_AT_ONCE = 1 << 17  # shingles whose bits are counted together

# The generator polynomial of the Golay code, and the segments' places and widths.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def _shingle_hashes(text: bytes):
    words = text.lower().split()
    if not words:
        return
    if len(words) <= SHINGLE:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(words) - SHINGLE + 1, _AT_ONCE):
        part = words[at : at + _AT_ONCE + SHINGLE - 1]
        shifted = zip(*[part[k:] for k in range(SHINGLE)])
        yield np.array([digest(b" ".join(s), SEED) for s in shifted], np.uint64)


def fingerprint(text: bytes) -> int:
    """The 64 bits as a signed number: bit k is set if it is set in over half of the shingles' hashes."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes(text):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        prints = [fingerprint(t.as_py() or b"") for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) per row of docs."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_python(docs.select("doc_id", "text"), _fingerprints, f"doc_id {kind}, print bigint")


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the words by their low 12 and high 11 bits; per remainder the error patterns of weight up to four.

    A row of patterns repeats its first where it has fewer than six.
    """
    low = np.array([_remainder(w) for w in range(1 << 12)], np.int64)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], np.int64)
    found: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in combinations(range(23), weight):
            pattern = sum(1 << b for b in bits)
            found.setdefault(int(low[pattern & 4095] ^ high[pattern >> 12]), []).append(pattern)
    patterns = np.array([(found[s] + found[s][:1] * 6)[:6] for s in range(1 << 11)], np.int64)
    return low, high, patterns


def code_indices(words: np.ndarray) -> np.ndarray:
    """Per 23-bit word six indices of codewords within distance four (repeated if there are fewer)."""
    low, high, patterns = _golay()
    near = words[:, None] ^ patterns[low[words & 4095] ^ high[words >> 12]]
    return near >> 11


def fuzzy_keys(prints: np.ndarray) -> np.ndarray:
    """Per fingerprint 18 keys, some of them equal."""
    unsigned = prints.view(np.uint64)
    segments = [((unsigned >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    keys = []
    for a, exact in enumerate(segments):
        index = code_indices(segments[(a + 1) % 3])
        keys.append((a << 36 | exact << 12)[:, None] | index)
    return np.concatenate(keys, axis=1)


def _keyed(batches):
    for batch in batches:
        prints = batch.column("print").to_numpy()
        keys = np.sort(fuzzy_keys(prints), axis=1)
        new = np.ones(keys.shape, bool)
        new[:, 1:] = keys[:, 1:] != keys[:, :-1]
        owner = np.repeat(prints, new.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(owner)], ["key", "print"])


def _around(batches):
    flips = np.concatenate([[0], np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))]).astype(np.uint64)
    for batch in batches:
        prints = batch.column("print").to_numpy()
        points = (prints.view(np.uint64)[:, None] ^ flips).view(np.int64).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(np.repeat(prints, 65))], ["key", "print"])


def _verified(batches):
    """The pairs of each bucket (at most MAX_BUCKET fingerprints) that differ in at most MAX_BITS bits."""
    for batch in batches:
        left, right = [], []
        for members in batch.column("prints"):
            p = members.values.to_numpy()
            i, j = np.triu_indices(len(p), 1)
            near = np.bitwise_count((p[i] ^ p[j]).view(np.uint64)) <= MAX_BITS
            left.append(p[i][near])
            right.append(p[j][near])
        both = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64)) for x in (left, right)]
        yield pa.RecordBatch.from_arrays(both, ["a", "b"])


def near_links(prints: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints (column print) whose components are those of all near pairs."""
    keyed = stored(in_python(prints, _keyed, "key bigint, print bigint"), "simhash-keys")
    sizes = keyed.groupBy("key").count().filter("count > 1")
    cold, hot = sizes.filter(F.col("count") <= MAX_BUCKET), sizes.filter(F.col("count") > MAX_BUCKET)
    buckets = keyed.join(cold, "key", "left_semi").groupBy("key").agg(F.collect_list("print").alias("prints"))
    pairs = in_python(buckets.select("prints"), _verified, "a bigint, b bigint")
    crowded = keyed.join(hot, "key", "left_semi").select("print").distinct()
    points = in_python(crowded, _around, "key bigint, print bigint").groupBy("key").agg(F.collect_list("print").alias("prints"))
    stars = points.filter(F.size("prints") > 1).select(F.array_min("prints").alias("a"), F.explode("prints").alias("b"))
    return pairs.unionByName(stars)


def near_groups(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, print, component_id (smallest doc_id reachable over links)."""
    prints = stored(fingerprints(docs), "simhash-prints")
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(near_links(classes.select("print")))
    rooted = classes.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = stored(rooted.join(smallest, "root").select(F.col("print").alias("_p"), "component_id"), "simhash-classes")
    return prints.join(members, F.col("print") == F.col("_p")).drop("_p")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    return near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs with only the smallest doc_id of each component; a repeated doc_id stays once."""
    keep = near_groups(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = keep.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").dropDuplicates(["doc_id"])
