"""The pipeline's near-duplicate stage against all pairs of exact 5-word shingle sets."""

import random

import numpy as np
import pytest

from corpus_pipeline import near_duplicates
from tidelog.llm import near, simhash
from tidelog.llm.common import stored


def _set(text) -> set:
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _survivors(rows) -> list:
    """Per component over pairs of Jaccard 0.8 or more the smallest doc_id, a null one last."""
    sets, roots = [_set(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) and roots[i] != roots[j]:
                roots = [roots[j] if r == roots[i] else r for r in roots]
    least = {}
    for row, root in zip(rows, roots):
        least.setdefault(root, []).append((row[0] is None, row[0] or 0))
    return sorted(min(ids) for ids in least.values())


def _changed(rng, words, share):
    """A copy in which about so many of the words are others."""
    return [f"w{rng.getrandbits(40)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("limit", [2, 64])
def test_near_copies(spark, monkeypatch, limit):
    monkeypatch.setattr(near, "MAX_BUCKET", limit)
    rng = random.Random(4)
    texts = [None, "", " \n", "one", "One ", "one two"]
    for _ in range(25):  # copies from about 0.95 down to about 0.75
        words = [f"w{rng.getrandbits(40)}" for _ in range(rng.randint(150, 600))]
        texts += [" ".join(words), *[" ".join(_changed(rng, words, share)) for share in (0.005, 0.01, 0.015, 0.02, 0.03)]]
    rows = [(None if i % 17 == 3 else i // 2 if i % 5 == 0 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == _survivors(rows)
    assert near_duplicates(spark, docs.limit(0), "").count() == 0


def test_rows_without_ids_stay(spark):
    rows = [(None, "a b c d e f"), (None, "g h i j k l"), (7, "m n o p q r"), (7, "s t u v w x"), (7, "s t u v w x")]
    kept = near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(r.text for r in kept.collect()) == sorted({t for _, t in rows})


def test_recall_of_keys():
    rng = np.random.default_rng(2)
    met = 0
    for _ in range(300):
        n = int(rng.integers(200, 2000))
        own = rng.integers(1, 1 << 63, n + n // 4, dtype=np.uint64)
        a, b = own[:n], own[: n - n // 9 - 1]  # n // 9 + 1 only in a, as many only in b: Jaccard 0.8
        b = np.append(b, own[n : n + n // 9 + 1])
        met += bool(set(near.band_keys(near.least_values(a))) & set(near.band_keys(near.least_values(b))))
    assert met >= 298


def _words(rng, n):
    return [f"w{rng.getrandbits(40)}" for _ in range(n)]


def _linked(spark, texts) -> set:
    """The components of near_classes as sets of texts' numbers, those of one text left out."""
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(4)
    roots = near.near_classes(docs).withColumnRenamed("root", "r")
    found = {}
    for row in docs.withColumn("node", near.text_class(docs.text)).join(roots, "node").collect():
        found.setdefault(row.r, set()).add(row.n)
    return {frozenset(x) for x in found.values() if len(x) > 1}


def test_pairs_within_a_common_part(spark, monkeypatch):
    """Pairs of 0.83 whose texts all share 0.74: every key of theirs may be crowded, none of the pairs is lost."""
    monkeypatch.setattr(near, "MAX_BUCKET", 4)
    rng = random.Random(8)
    common, texts = _words(rng, 400), []
    for _ in range(60):
        own = _words(rng, 40)
        texts += [" ".join(common + own + _words(rng, 41)) for _ in range(2)]
    sets = [_set(t) for t in texts]
    similarity = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    apart = len(sets[0] & sets[2]) / len(sets[0] | sets[2])
    assert min(similarity) >= 0.8 > apart > 0.7
    assert _linked(spark, texts) == {frozenset((2 * i, 2 * i + 1)) for i in range(60)}


@pytest.mark.parametrize("rounds", [0, 2])
def test_dense_groups(spark, monkeypatch, rounds):
    """Copies of one text around 0.8 of each other: rare shingles are crowded too, and links decide by single shingles."""
    monkeypatch.setattr(near, "MAX_BUCKET", 3)
    monkeypatch.setattr(near, "PIVOT_ROUNDS", rounds)
    rng = random.Random(9)
    texts = []
    for group in range(3):
        parts = [_words(rng, 12) for _ in range(40)]
        for _ in range(40):
            texts.append(" ".join(w for part in parts if rng.random() > 0.13 + 0.02 * group for w in part))
    rows = list(enumerate(texts))
    kept = near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), "")
    assert sorted((False, r.doc_id) for r in kept.collect()) == _survivors(rows)


def test_prefixes_share_a_shingle():
    """Whatever the order's places hold, sets of 0.8 share one of their rare shingles."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        own = np.unique(rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64))[:n]
        a, b = np.sort(rng.permutation(own)[: max(1, n - n // 10)]), own
        if not near.similar(a, b):
            continue
        order = np.zeros(near.ORDER_PLACES, np.int32)
        order[near.places(own)] = rng.integers(2, 5, n)
        assert set(near.rare_shingles(a, order)) & set(near.rare_shingles(b, order))


def test_stage_takes_its_fingerprints_links(spark, monkeypatch):
    """Near copies whose fingerprints differ in two bits at most are linked by simhash, before and without any band."""
    words = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words) + " end"), (3, " ".join(reversed(words))), (4, " ".join(words).upper())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert bin((simhash.fingerprint(rows[0][1].encode()) ^ simhash.fingerprint(rows[1][1].encode())) % 2**64).count("1") <= 2
    names = {r[0]: r[1] for r in docs.select("doc_id", near.text_class(docs.text)).collect()}
    found = near.connected_components(near.fingerprint_links(docs)).collect()
    assert {r["node"] for r in found} == {names[k] for k in (1, 2, 4)} and len({r["root"] for r in found}) == 1
    seen = []
    monkeypatch.setattr(near, "_bucket_pairs", lambda shared, real=near._bucket_pairs: seen.append(shared.count()) or real(shared))
    assert sorted(r[0] for r in near_duplicates(spark, docs, "").collect()) == [1, 3]
    assert seen == [0]


def test_first_shared_shingle_has_what_sets_share_behind_it():
    """The test on crowded rare shingles passes a similar pair at the first shingle that it shares, and few others."""
    rng = np.random.default_rng(5)
    least = near.MIN_SIMILARITY / (1 + near.MIN_SIMILARITY)
    similar = passed = apart = 0
    for _ in range(600):
        n = int(rng.integers(10, 120))
        own = np.unique(rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64))[: n + n // 4]
        other = own[: n + int(rng.integers(1, n // 4 + 1))]
        a, b = (np.sort(rng.permutation(other)[:n]) for _ in range(2))
        order = np.zeros(near.ORDER_PLACES, np.int32)
        order[near.places(own)] = rng.integers(2, 5, len(own))
        (keys_a, left_a), (keys_b, left_b) = near.rare_and_left(a, order), near.rare_and_left(b, order)
        assert list(keys_a) == list(near.rare_shingles(a, order))
        _, i, j = np.intersect1d(keys_a, keys_b, return_indices=True)
        fits = np.minimum(left_a[i], left_b[j]) >= least * (len(a) + len(b)) - 1e-6
        if near.similar(a, b):
            similar += 1
            assert fits.any()
        elif len(i):
            apart += 1
            passed += fits.sum() / len(i)
    assert similar > 50 and apart > 50 and passed < apart


def test_shuffle_files_go_with_the_write(spark):
    """A stored table leaves no shuffle files; the session's setting is as before."""
    store = spark._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {f.getName() for f in [store.getAllFiles().apply(i) for i in range(store.getAllFiles().size())] if f.getName().startswith("shuffle_")}
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffles()
    value = spark.conf.get(key, None)
    kept = stored(spark.range(20_000).repartition(7, "id"), "shuffled")
    assert not [f for f in shuffles() - before if f.endswith(".data")]
    assert kept.count() == 20_000
    assert spark.conf.get(key, None) == value
