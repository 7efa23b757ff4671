"""Each operator against a brute-force version, on a small table with the cases that its docstring defines."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelog.llm import ann, classifier, mixing, packing, rules, simhash, substring, suffix, templates, warc
from tidelog.settings import scratch_dir

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, doc string, size int, "
    "slice int, print string, anchors int, template string, drops int, h bigint, rank int"
)


def _table() -> list[tuple]:
    """Documents with shared passages, near copies, nulls, blanks, one long text and repeated rows."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        words = [rng.choice(vocabulary) for _ in range(n)]
        return "".join(w + rng.choice([" ", " ", " ", "\n", "\t", ". "]) for w in words)

    shared = [prose(70) for _ in range(4)]
    texts = []
    for i in range(60):
        parts = [prose(rng.randint(1, 90))]
        for p in shared:
            if rng.random() < 0.3:
                parts.insert(rng.randint(0, len(parts)), p[rng.randint(0, 40) :])
        if rng.random() < 0.4:
            parts.insert(1, f"\nAll rights reserved 20{i}.\n")
        texts.append(" ".join(parts))
    copies = [texts[0]] * 3 + [texts[1].replace("a", "b", 1), texts[2] + " tail", "x" * 500, "ab " * 300]
    long = prose(6000) + shared[0]
    texts += copies + [long, None, None, "", " \n\t ", "one", "one two", "<|endoftext|> Don't 12.5% É", "A\xa0B c"]
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 4 if i % 3 else 0}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[-1]]
    return [(*r, True, "x", 1, 2, "p", 3, "t", 4, 5, 6) for r in rows]


@pytest.fixture(scope="module")
def rows():
    return _table()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = scratch_dir(spark, "fixture")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text) -> list[bytes]:
    return WORD.findall((text or "").encode())


def collected(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# 1


def test_warc_round_trip(spark, rows):
    pages = [(i, None if i % 7 == 0 else f"http://a/{i}\r\nX: y", r[1]) for i, r in enumerate(rows)]
    # A payload that looks like the start of a record, and one that isn't compressible.
    pages += [(900, "u", "\x1f\u0008WARC/1.1\r\n\r\n"), (901, "u", "".join(chr(random.Random(i).randint(32, 999)) for i in range(40000)))]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    archives = warc.write_archives(df, scratch_dir(spark, "archives"))
    last = {}
    for i, _, html in pages:
        last[html or ""] = i
    expected = Counter()
    for i, _, html in pages:
        payload, of = (html or "").encode(), last[html or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected[(i, len(payload), digest, "response" if of == i else "revisit", None if of == i else of)] += 1
    for split in (100, 5000, warc.SPLIT_BYTES):
        assert collected(warc.read_archives(archives, split_bytes=split).drop("url")) == expected
    full = {r.page_id: r for r in warc.read_archives(archives, with_payload=True).collect()}
    for i, url, html in pages:
        assert full[i].payload == ((html or "").encode() if last[html or ""] == i else None)
        assert full[i].url == (None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"))
    assert warc.archive_report(spark, df.limit(0)).count() == 0


def test_no_record_at_a_false_magic():
    member = warc.gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n", mtime=0)
    noise = warc.MAGIC + b"\x00" * 30 + warc.gzip.compress(b"other", mtime=0)
    import io

    data = noise + member + noise + member
    whole = list(warc.records_in(io.BytesIO(data), 0, len(data)))
    assert len(whole) == 2
    for size in (1, 7, 64):
        parts = [r for at in range(0, len(data), size) for r in warc.records_in(io.BytesIO(data), at, min(at + size, len(data)))]
        assert parts == whole


# 2


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((900, 12)).astype(np.float32)
    x[100:140] = x[7]  # copies
    x[300:600] = x[8] + 1e-3 * rng.standard_normal((300, 12))  # a dense group
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    bad = [(1000, None), (1100, []), (1200, [0.0] * 12), (1300, [float("nan")] * 12), (1400, [1.0, None] * 6), (1500, [1.0])]
    vectors = spark.createDataFrame(rows + bad + rows[:1], "vec_id bigint, embedding array<float>")
    found = {}
    for q, rank, v, score in ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        found.setdefault(q, []).append((rank, v, score))
    assert sorted(found) == list(range(0, 900, 100))
    hits = 0
    for q, answers in found.items():
        gaps = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(900), gaps)) if i != q][:10]
        hits += len(set(best) & {v for _, v, _ in answers})
        assert [a[0] for a in answers] == list(range(1, len(answers) + 1))
        assert all(math.isclose(gaps[v], s, rel_tol=1e-12, abs_tol=1e-12) for _, v, s in answers)
        assert answers == sorted(answers, key=lambda a: (a[2], a[1]))
    assert hits >= 0.9 * 10 * len(found)
    assert ann.nearest_neighbours(vectors.limit(0), vectors.limit(0)).count() == 0
    few = ann.nearest_neighbours(vectors.filter("vec_id in (0, 1, 2)"), vectors.filter("vec_id = 0"))
    assert {r.vec_id for r in few.collect()} == {1, 2}


# 3


def _cut_words(rows, window):
    seen: dict[bytes, int] = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            key = b" ".join(w[k : k + window])
            seen[key] = min(seen.get(key, doc_id), doc_id)
    for doc_id, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[b" ".join(w[k : k + window])] < doc_id:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        yield doc_id, len(w), sum(gone), sha(kept)


def test_substring(spark, docs, rows, empty):
    expected = Counter(_cut_words(rows, substring.WINDOW))
    assert sum(r[2] for r in expected) > 500
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("2", "40"):  # ranges that cut groups apart
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", n == "2")
            assert collected(substring.substring_report(docs)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert substring.substring_report(empty).count() == 0


def test_cover_aligns_any_two_places():
    for i in range(substring.PERIOD):
        assert any((c + i) % substring.PERIOD in substring.COVER for c in substring.COVER)


# 4


def test_mixing(docs, rows, empty):
    report = mixing.mix_report(docs)
    found = [r.asDict() for r in report.collect()]
    sizes, of = Counter(), {}
    for doc_id, text, _, source, *_ in rows:
        sizes[source] += len(words(text))
        of[doc_id] = source
    assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in found) == Counter(
        (r[0], len(words(r[1])), sizes[r[3]]) for r in rows
    )
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    targets, open_, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while open_:
        share = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if share * weights[s] >= 2 * sizes[s]}
        if not full:
            targets |= {s: share * weights[s] for s in open_}
            break
        for s in full:
            targets[s] = 2.0 * sizes[s]
            left -= targets[s]
        open_ -= full
    taken = Counter()
    for r in found:
        s = of[r["doc_id"]]
        assert math.isclose(r["target"], targets[s], rel_tol=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    longest = max(len(words(r[1])) for r in rows)
    assert all(abs(taken[s] - targets[s]) <= longest for s in sizes)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert collected(mixing.mix_report(docs.repartition(3))) == collected(report)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r[0] for r in mixed.collect()).total() == sum(r["taken"] // r["size"] for r in found if r["size"])
    assert mixing.mix_report(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


# 5


def test_classifier(spark, docs, rows, empty):
    rng = random.Random(2)
    good = [(i, " ".join(rng.choice(["the", "of", "sun", "rain"]) for _ in range(60))) for i in range(400)]
    noisy = [(i, t if i % 3 else re.sub(" ", "## ", t)) for i, t in good]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in good], "doc_id bigint, quality int")
    scored = classifier.quality_scores(spark.createDataFrame(noisy, "doc_id bigint, text string"), labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    held = [r for r in scored if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)
    assert classifier.quality_scores(docs, labels.limit(0)).filter("score = 0.5").count() == len(rows)
    assert classifier.quality_scores(empty, labels).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 896, 897, 5000])
def test_chunks_cover_the_whole_text(n):
    text = bytes(random.Random(n).randint(1, 255) for _ in range(n))
    chunks = classifier.chunked(text)
    whole = b"".join(c[: classifier.STEP].tobytes() for c in chunks[:-1]) + chunks[-1].tobytes()
    assert whole[:n] == text and not any(whole[n:])


# 6


def _cut_bytes(rows, length):
    seen = Counter()
    for _, text, *_ in rows:
        b = (text or "").encode()
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    for doc_id, text, *_ in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        yield doc_id, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))


def test_suffix_dedup(docs, rows, empty):
    expected = Counter(_cut_bytes(rows, suffix.LENGTH))
    assert sum(r[2] for r in expected) > 5000
    assert collected(suffix.suffix_report(docs)) == expected
    assert suffix.suffix_report(empty).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(300):
        text = np.append(rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(0, 80))), 0)
        expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        for limit in (0, 1 << 30):  # arrays in files, and in memory
            scratch = suffix._Scratch(limit)
            assert suffix.suffix_array(text, scratch).tolist() == expected
            scratch.close()


# 7


def test_line_dedup(spark, docs, rows, empty):
    assert templates.line_templates(b"  \t ") == ()
    a, b = templates.line_templates(b"user 17 logged in from host alpha at 10:30 today")
    c, d = templates.line_templates(b"user 99 logged in from host gamma at 11:45 today")
    assert {a, b} & {c, d}
    boiler = [(1000 + i, f"{chr(97 + i) * 5} begins here\nRead more at page {i}\nand {chr(107 + i) * 4} ends it") for i in range(10)]
    copies = [(2000 + i, "a line of the copy\nnext line of the copy\nlast line of the copy") for i in range(20)]
    some = spark.createDataFrame(boiler + copies + [(1, None), (2, ""), (3, "alone")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in templates.line_dedup_report(some).collect()}
    for i, text in boiler:
        kept = "\n".join(line for line in text.split("\n") if not line.startswith("Read more"))
        assert (found[i].n_removed, found[i].kept_sha256) == (1, sha(kept.encode()))
    assert all(found[i].n_removed == 0 for i, _ in copies) and found[3].n_removed == 0
    assert (found[1].n_lines, found[2].n_lines) == (0, 0)
    wide = collected(templates.line_dedup_report(docs, min_documents=3))
    assert wide == collected(templates.line_dedup_report(docs, min_documents=3, limit=0))
    cut = templates.without_recurring_lines(docs, min_documents=3)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert templates.line_dedup_report(empty).count() == 0


# 8


def test_packing(docs, rows, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    pieces = [r.asDict() for r in packing.packed(docs).collect()]
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), packing.SEQUENCE):
            part = np.array(ids[at : at + packing.SEQUENCE], "<u4")
            expected[(doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((p["doc_id"], p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces) == expected
    filled = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == filled.get(p["sequence_id"], 0)
        filled[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(filled.values()) <= packing.SEQUENCE
    assert packing.packed(empty).count() == 0


def test_patterns_hold_every_piece():
    rng = random.Random(4)
    for _ in range(50):
        histogram = {rng.randint(1, 64): rng.randint(1, 200) for _ in range(rng.randint(0, 30))}
        held = Counter()
        for count, lengths in packing.shortest_pack_first(histogram, 64):
            assert sum(lengths) <= 64
            for n in lengths:
                held[n] += count
        assert held == Counter(histogram)


# 9


def _measures(text):
    w, t = words(text), text or ""
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x.encode())]
    n = len(w)
    return (
        n, sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(covered), n < 20 or 100 * len(covered) > 30 * n,
    )


def test_quality_rules(spark, docs, rows, empty):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert collected(rules.quality_report(docs).select(columns)) == Counter((r[0], *_measures(r[1])) for r in rows)
    clean = "It was a fine day and they went out to see the hills again. "
    lines = {
        "good": clean * 1 + "Then nobody came back for a while, so we left the house at noon.",
        "shout": "\n".join(f"ALL OF IT {i} IS LOUD AND LONG AND MORE {chr(65 + i)}" for i in range(6)),
        "menu": "\n".join(f"Home {i} | About {i} | Contact {i} | Search {i}" for i in range(6)),
        "marks": " ".join(f"w{i}### v{i}$$$" for i in range(30)),
        "license": clean + "Then nobody came back for long, so we left it.\nAll rights reserved.",
    }
    df = spark.createDataFrame(list(enumerate(lines.values())), "doc_id bigint, text string")
    kept = {r.doc_id: r.kept for r in rules.quality_report(df).collect()}
    assert [kept[i] for i in range(5)] == [True, False, False, False, True]
    cleaned = {r.doc_id: r.text for r in rules.clean_documents(df).collect()}
    assert cleaned[0] == lines["good"] and "reserved" not in cleaned[4]
    assert rules.clean_documents(docs).columns == docs.columns
    assert rules.quality_report(empty).count() == 0 and rules.clean_documents(empty).count() == 0


# 10


def _fingerprint(text):
    w = words((text or "").encode().lower().decode())
    if not w:
        return 0
    shingles = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def _components(prints: dict) -> dict:
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in prints}


def test_simhash(docs, rows, empty):
    prints = {r[0]: _fingerprint(r[1]) for r in rows}
    roots = _components(prints)
    expected = Counter((r[0], f"{prints[r[0]]:016x}", roots[r[0]]) for r in rows)
    assert collected(simhash.near_duplicate_report(docs)) == expected
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == sorted(set(roots.values()))
    assert simhash.near_duplicate_report(empty).count() == 0


def test_links_of_crowded_and_plain_buckets(spark, monkeypatch):
    rng = random.Random(9)
    prints = set()
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(25):
            prints.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    prints = sorted(prints)
    roots = _components(dict(enumerate(prints)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print bigint")
    for limit in (2, 64):
        monkeypatch.setattr(simhash, "MAX_BUCKET", limit)
        found = dict(tuple(r) for r in simhash.connected_components(simhash.near_links(df)).collect())
        groups = Counter(found.get(p, p) for p in signed)
        assert sorted(groups.values()) == sorted(Counter(roots.values()).values())


def test_golay_indices_meet():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 23, 20000)
    flips = np.array([0, *[1 << k for k in range(23)]])
    b = a ^ rng.choice(flips, len(a)) ^ rng.choice(flips, len(a))
    x, y = simhash.code_indices(a), simhash.code_indices(b)
    assert (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).all()


# Pipeline


def test_pipeline(spark):
    import corpus_pipeline

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, path = table.count(), scratch_dir(spark, name)
        stage(spark, table, "/root/testdata/sf0.001").write.parquet(path)
        table = spark.read.parquet(path)
        assert table.columns == documents.columns
        assert table.count() <= (2 if name == "mixing" else 1) * before
    last = corpus_pipeline.STAGES[-1][1](spark, table, "/root/testdata/sf0.001")
    assert collected(last) == collected(corpus_pipeline.run(spark, "/root/testdata/sf0.001"))
    assert last.agg(F.countDistinct("sequence_id")).first()[0] > 0
