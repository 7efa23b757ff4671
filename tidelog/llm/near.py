"""The pipeline's near-duplicates: texts whose sets of 5-word shingles have a Jaccard similarity of MIN_SIMILARITY or more.

First come the components of `simhash`: each text is held against the smallest of its component by exact shingle sets, and is
linked if similar. Two bits find few pairs below 0.97. For the rest a text has BANDS keys, each of the least values of ROWS
random functions over its shingles; texts of similarity 0.8 share a key with 0.999. Pairs that share one and aren't linked
yet are verified by their exact shingle sets, and verified pairs are linked.

Equal texts are one class before all this. A key with more than MAX_BUCKET classes isn't paired: its members are verified
against its smallest class, then in PIVOT_ROUNDS rounds those outside the key's largest component against one more of that
component. Members of keys that still aren't one component meet again, whatever their keys, by their rarest shingles: under
one order of all shingles, sets of similarity 0.8 share one of the first fifth of each (prefix filter), which is exact. The
order is by how often shingles occur among these members, counted in ORDER_PLACES places by hash; two shingles in one place
are ordered less well, never wrongly. A rare shingle in up to MAX_BUCKET members has them paired; of one in more, all
members outside its largest component are verified against all its members of other components whose number of shingles, and
of those that follow the shared one in the order, permits it. So no pair of a crowded key is left out; what is lost is only what shares no key at all.

Defined cases: letter case (ASCII) and the kind of white space make no difference; texts of fewer than five words are one
shingle; null and blank texts are equal; per component the row with the smallest doc_id stays (a null one counts as larger
than any), of several that with the smallest hash; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import simhash
from tidelog.llm.common import as_rows, in_python, settled, small, stored
from tidelog.llm.components import connected_components
from tidelog.llm.hashing import MULTIPLIERS, ranges_hash, windows_hash, word_hashes

SHINGLE = 5
MIN_SIMILARITY = 0.8
BANDS = 24
ROWS = 6
MAX_BUCKET = 64
PIVOT_ROUNDS = 2
ORDER_PLACES = 1 << 20
_AT_ONCE = 1 << 9  # shingles that are hashed together
_PAIRS = 1 << 16

# A random odd factor and a mask per function.
_FACTORS, _MASKS = np.random.default_rng(11).integers(1, 1 << 31, (2, BANDS * ROWS, 1), dtype=np.uint32)
_FACTORS = _FACTORS * np.uint32(2) + np.uint32(1)


def shingles(text: bytes) -> np.ndarray:
    """The set of the text's shingles as sorted hashes."""
    words = word_hashes(text.lower())
    if not len(words):
        return np.empty(0, np.uint64)
    own = np.sort(windows_hash(words, min(SHINGLE, len(words)), MULTIPLIERS[0]))
    return own[np.append(True, own[1:] != own[:-1])]


def least_values(own: np.ndarray) -> np.ndarray:
    """Of 32 bits, which make two keys equal by chance now and then: only one more candidate."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    low = own.astype(np.uint32)
    for at in range(0, len(own), _AT_ONCE):
        least = np.minimum(least, ((low[at : at + _AT_ONCE] ^ _MASKS) * _FACTORS).min(axis=1))
    return least.astype(np.uint64)


def _hashed(values: np.ndarray) -> np.ndarray:
    """A number per row of values."""
    starts = np.arange(len(values)) * values.shape[1]
    return ranges_hash(values.ravel(), starts, starts + values.shape[1], MULTIPLIERS[1]).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    bands = np.arange(BANDS, dtype=np.uint64)[:, None]
    return _hashed(np.concatenate([bands, least.reshape(BANDS, ROWS)], axis=1))


def places(own: np.ndarray) -> np.ndarray:
    return ((own * MULTIPLIERS[1]) >> np.uint64(32)).astype(np.int64) % ORDER_PLACES


def rare_shingles(own: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The first of the set's shingles by their count in order; without those that no other set has.

    Two sets that reach MIN_SIMILARITY share one: each lacks at most a fifth of the larger one's shingles.
    """
    return rare_and_left(own, order)[0]


def rare_and_left(own: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`rare_shingles`, and per shingle how many of the set's stand in the order from it on.

    The first shingle that two sets share has all their common ones from it on, so the lesser of its two numbers is no less than
    what the sets have in common.
    """
    counts = order[places(own)]
    first = np.lexsort((own, counts))[: len(own) - math.ceil(MIN_SIMILARITY * len(own) - 1e-6) + 1]
    seen = counts[first] > 1
    return own[first[seen]], (len(own) - np.arange(len(first), dtype=np.int32))[seen]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted, without repeats) reach MIN_SIMILARITY."""
    small, large = sorted((len(a), len(b)))
    if small < MIN_SIMILARITY * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= MIN_SIMILARITY * (small + large - both)


def _sketches(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        sets = [shingles(t.as_py() or b"") for t in texts]
        keys = pa.array([band_keys(least_values(own)) for own in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(map(len, sets), pa.int32()), keys], ["class", "size", "bands"])


def _place_counts(batches):
    """Per task how many shingles of its texts fall to each place."""
    counts = np.zeros(ORDER_PLACES, np.int64)
    for batch in batches:
        for text in batch.column("text").cast(pa.binary()):
            np.add.at(counts, places(shingles(text.as_py())), 1)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["place", "n"])


def _rare(order):
    def rare(batches):
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            for at, own in enumerate(sets):
                key, left = rare_and_left(own, order.value)
                repeated = pa.array(np.full(len(key), at))
                columns = [batch.column(x).take(repeated) for x in ("class", "root")]
                numbers = [pa.array(np.full(len(key), len(own), np.int32)), pa.array(left.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *columns, *numbers], ["key", "class", "root", "size", "left"])

    return rare


def _paired(batches):
    """The pairs of each bucket (at most MAX_BUCKET classes) that aren't of one component and may be similar by their sizes."""
    for batch in batches:
        found, size = [], 0
        for members, roots, sizes in zip(batch.column("members"), batch.column("roots"), batch.column("sizes")):
            p, root, n = (x.values.to_numpy() for x in (members, roots, sizes))
            i, j = np.triu_indices(len(p), 1)
            apart = (root[i] != root[j]) & (np.minimum(n[i], n[j]) >= MIN_SIMILARITY * np.maximum(n[i], n[j]))
            i, j = i[apart], j[apart]
            found.append((np.maximum(p[i], p[j]), np.minimum(p[i], p[j])))
            size += len(i)
            if size > _PAIRS:
                yield _pair_batch(found)
                found, size = [], 0
        yield _pair_batch(found)


def _pair_batch(found: list[tuple]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _verified(batches):
    for batch in batches:
        keep, last, b = [], None, None
        texts = zip(batch.column("b").to_pylist(), batch.column("text_a").cast(pa.binary()), batch.column("text_b").cast(pa.binary()))
        for name, text_a, text_b in texts:
            if name != last:
                last, b = name, shingles(text_b.as_py())
            keep.append(similar(shingles(text_a.as_py()), b))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _shared(keyed: DataFrame, label: str) -> DataFrame:
    """(key, class, root, size, n, first) of the keys that hold more than one root: n rows, first is the smallest class."""
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("first"), F.min("root").alias("least"), F.max("root").alias("most"))
    return stored(keyed.join(sizes.filter("least <> most").select("key", "n", "first"), "key"), label)


def _bucket_pairs(shared: DataFrame) -> DataFrame:
    """Candidates (a, b) of the keys that aren't crowded."""
    buckets = shared.filter(F.col("n") <= MAX_BUCKET).groupBy("key").agg(F.collect_list(F.struct("class", "root", "size")).alias("rows"))
    lists = [F.col(f"rows.{x}").alias(y) for x, y in (("class", "members"), ("root", "roots"), ("size", "sizes"))]
    return in_python(buckets.select(*lists), _paired, "a bigint, b bigint")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _outside(crowded: DataFrame, roots: DataFrame, step: int) -> tuple[DataFrame, DataFrame]:
    """The rows of keys that aren't one component yet, and of those the ones outside the key's largest, with a pivot in that."""
    members = _rooted(crowded, roots)
    order = F.xxhash64("class", F.lit(step))  # one pivot for all keys that hold it
    per_root = members.groupBy("key", "root").agg(F.count("*").alias("n"), F.min_by("class", order).alias("pivot"))
    best = F.max(F.struct("n", "root", "pivot")).alias("best")
    largest = per_root.groupBy("key").agg(best, F.count("*").alias("roots")).filter("roots > 1").select("key", "best.root", "best.pivot")
    rows = stored(members.join(largest.withColumnRenamed("root", "most"), "key"), "near-open")
    return rows, rows.filter("root <> most")


def _texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(class, text) of the classes in pairs; texts has equal rows for equal texts."""
    needed = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    needed = stored(needed, "near-needed")
    if small(needed, 32):
        texts = texts.join(F.broadcast(needed), "class", "left_semi")
        return stored(texts.groupBy("class").agg(F.first("text").alias("text")), "near-texts")
    one = texts.groupBy("class").agg(F.first("text").alias("text"))  # copies are one row per task before the shuffle
    return stored(one.join(needed, "class", "left_semi"), "near-texts")


def _links(pairs: DataFrame, own: DataFrame, label: str) -> DataFrame:
    """The candidates that are similar; own is (class, text)."""
    a, b = (own.select(F.col("class").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    return stored(in_python(pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b"), _verified, "a bigint, b bigint"), label)


def text_class(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _rooted(classes: DataFrame, roots: DataFrame) -> DataFrame:
    return classes.join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class")).drop("node")


def _rare_links(rows: DataFrame, own: DataFrame) -> DataFrame:
    """The links of different components among the classes of rows (class, root), by shared rare shingles."""
    texts = stored(own.join(rows.select("class", "root").distinct(), "class"), "near-open-texts")
    counts = in_python(texts.select("text"), _place_counts, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    order = np.zeros(ORDER_PLACES, np.int32)  # ORDER_PLACES numbers, at every size
    order[counts["place"].to_numpy()] = np.minimum(counts["n"].to_numpy(), np.iinfo(np.int32).max)
    order = rows.sparkSession.sparkContext.broadcast(order)
    shared = _shared(in_python(texts, _rare(order), "key bigint, class bigint, root bigint, size int, left int"), "near-rare")
    links = _links(stored(_bucket_pairs(shared).distinct(), "near-rare-pairs"), own, "near-rare-links")
    crowded = shared.filter(F.col("n") > MAX_BUCKET).select("key", "class", "size", "left", F.col("root").alias("before"))
    if crowded.isEmpty():
        return links
    # Components of the first pass are nodes here: those that were linked since are one.
    merged = links.join(texts.select(F.col("class").alias("a"), F.col("root").alias("root_a")), "a")
    merged = merged.join(texts.select(F.col("class").alias("b"), F.col("root").alias("root_b")), "b")
    merged = stored(connected_components(merged.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "near-rare-roots")
    rooted = crowded.join(merged, F.col("before") == F.col("node"), "left").withColumn("root", F.coalesce("root", "before"))
    largest = rooted.groupBy("key", "root").count().groupBy("key").agg(F.max(F.struct("count", "root")).alias("best"), F.count("*").alias("roots"))
    rooted = rooted.select("key", "class", "size", "left", "root")
    outside = rooted.join(largest.filter("roots > 1").select("key", F.col("best.root").alias("most")), "key").filter("root <> most")
    others = rooted.select("key", *[F.col(x).alias(f"other_{x}") for x in ("class", "size", "left", "root")])
    # A similar pair passes at the first shingle that it shares: there the rest of either holds all that both have.
    least = MIN_SIMILARITY / (1 + MIN_SIMILARITY) * (F.col("size") + F.col("other_size")) - 1e-6
    fits = (F.least("size", "other_size") >= MIN_SIMILARITY * F.greatest("size", "other_size")) & (F.least("left", "other_left") >= least)
    pairs = outside.join(others, "key").filter((F.col("root") != F.col("other_root")) & fits)
    pairs = stored(pairs.select(*_ordered(F.col("class"), F.col("other_class"))).distinct(), "near-rest-pairs")
    return links.unionByName(_links(pairs, own, "near-rest-links"))


def fingerprint_links(docs: DataFrame) -> DataFrame:
    """The links (a, b) between the classes of one component of `simhash` that are similar: each class and the smallest."""
    texts = docs.select(text_class(F.col("text")).alias("class"), F.coalesce("text", F.lit("")).alias("text"))
    prints = simhash.fingerprints(texts.withColumnRenamed("class", "doc_id")).distinct()
    prints = stored(prints.withColumnRenamed("doc_id", "class"), "near-prints")
    roots = connected_components(simhash.near_links(prints.select("print").distinct()))
    rooted = prints.join(roots, F.col("print") == F.col("node"), "left").select("class", F.coalesce("root", "print").alias("root"))
    first = rooted.groupBy("root").agg(F.min("class").alias("b"), F.count("*").alias("n")).filter("n > 1")
    pairs = stored(rooted.join(first, "root").filter("class <> b").select(F.col("class").alias("a"), "b"), "near-print-pairs")
    return _links(pairs, _texts_of(pairs, texts), "near-print-links")


def near_classes(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(node, root): the classes of texts that are linked, and their component's smallest; found are links (a, b) known before."""
    texts = docs.select(text_class(F.col("text")).alias("class"), F.coalesce("text", F.lit("")).alias("text"))
    sketches = in_python(texts, _sketches, "class bigint, size int, bands array<bigint>")
    sketches = stored(sketches.dropDuplicates(["class"]), "near-sketches")
    if found is None:
        sketches = sketches.withColumn("root", F.col("class"))
    else:
        sketches = _rooted(sketches, stored(connected_components(found), "near-found-roots"))
    shared = _shared(sketches.select(F.explode("bands").alias("key"), "class", "root", "size"), "near-keys")
    crowded = shared.filter(F.col("n") > MAX_BUCKET)
    stars = crowded.filter("class <> first").select(F.col("class").alias("a"), F.col("first").alias("b"))
    pairs = stored(_bucket_pairs(shared).unionByName(stars).distinct(), "near-pairs")
    own = _texts_of(pairs, texts)
    links = _links(pairs, own, "near-links")
    links = links if found is None else links.unionByName(found)
    roots = stored(connected_components(links), "near-roots")
    # All members of crowded keys are in pairs, so their texts are in own.
    crowded = crowded.select("key", "class")
    for step in range(PIVOT_ROUNDS):
        rows, outside = _outside(crowded, roots, step)
        if rows.isEmpty():
            return roots
        pairs = stored(outside.select(*_ordered(F.col("class"), F.col("pivot"))).distinct(), "near-pivots")
        links = links.unionByName(_links(pairs, own, "near-pivot-links"))
        roots = stored(connected_components(links), "near-roots")
        crowded = rows.select("key", "class")
    rows, _ = _outside(crowded, roots, PIVOT_ROUNDS)
    if rows.isEmpty():
        return roots
    return connected_components(links.unionByName(_rare_links(rows, own)))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of docs per component."""
    rows = as_rows(docs).select("doc", text_class(F.col("doc.text")).alias("class"), F.xxhash64("doc").alias("row_hash"))
    order = F.struct(F.col("doc.doc_id").isNull().alias("no_id"), F.col("doc.doc_id").alias("doc_id"), "row_hash", "class")
    # Each row's place in the order, and how many rows it stands for: rows alike in all columns are one.
    slim = stored(rows.groupBy("class", "row_hash").agg(F.min(order).alias("least"), F.count("*").alias("n")), "near-rows")
    least = slim.groupBy("class").agg(F.min("least").alias("least"))

    def best() -> DataFrame:
        found = settled(lambda: fingerprint_links(docs), "near-found")
        firsts = _rooted(least, near_classes(docs, found)).groupBy("root").agg(F.min("least").alias("least"))
        return firsts.select(F.col("least.class").alias("_class"), F.col("least.row_hash").alias("_hash"))

    best = settled(best, "near-best")
    same = (F.col("class") == F.col("_class")) & (F.col("row_hash") == F.col("_hash"))
    # The rows that go, and of those that stay the ones that stand for several, are few as a rule: then the others, by far the
    # most bytes, are kept where they are.
    gone = slim.join(best, same, "left_anti").select("class", "row_hash", F.lit(False).alias("stays"))
    several = slim.filter("n > 1").join(best, same, "left_semi").select("class", "row_hash", F.lit(True).alias("stays"))
    noted = stored(gone.unionByName(several), "near-noted")
    if small(noted, 64):
        told = rows.join(F.broadcast(noted), ["class", "row_hash"], "left")
        once = told.filter("stays").dropDuplicates(["class", "row_hash"])
        return told.filter("stays is null").select("doc.*").unionByName(once.select("doc.*"))
    return rows.join(best, same, "left_semi").dropDuplicates(["class", "row_hash"]).select("doc.*")
