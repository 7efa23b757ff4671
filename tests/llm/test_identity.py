"""Rows without an id, and rows that share one with another text."""

import base64
import gzip
import hashlib
import random
from collections import Counter

from tidelog.llm import substring, suffix, warc
from tidelog.settings import scratch_dir


def table(seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(200)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [prose(90) for _ in range(3)]
    rows = [(i, f"{prose(rng.randint(5, 60))} {rng.choice(shared)} {prose(rng.randint(5, 60))}") for i in range(20)]
    # Another, longer or shorter, text of an id; the same text twice; no id, with and without a copy elsewhere.
    rows += [(3, prose(400)), (3, shared[0]), (7, prose(3)), (8, prose(10) + " " + shared[1]), rows[5], rows[5]]
    rows += [(None, rows[4][1]), (None, prose(50)), (None, rows[2][1]), (None, rows[2][1]), (None, None), (21, None)]
    rng.shuffle(rows)
    return rows


def test_suffix_report(spark):
    rows, length = table(), 200
    starts = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        starts.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    expected = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if starts[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        expected.append((doc_id, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert Counter(map(tuple, suffix.suffix_report(docs).collect())) == Counter(expected)
    named = docs.selectExpr("'d' || doc_id AS doc_id", "text")
    texts = Counter((e[0] if e[0] is None else f"d{e[0]}", *e[1:]) for e in expected)
    assert Counter(map(tuple, suffix.suffix_report(named).collect())) == texts


def test_substring_report(spark):
    rows, window = [r for r in table() if r[0] is not None], 50
    least = {}
    split = [(doc_id, (text or "").split()) for doc_id, text in rows]
    for doc_id, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            least[key] = min(least.get(key, doc_id), doc_id)
    expected = []
    for doc_id, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if least[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        expected.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert Counter(map(tuple, substring.substring_report(docs).collect())) == Counter(expected)


def test_pages_without_an_id(spark):
    pages = [(4, "http://a/", "x"), (None, "http://b/", "x"), (None, "http://c/", "alone"), (None, None, "two"), (None, None, "two"), (9, None, "x")]
    found = warc.archive_report(spark, spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    sha = lambda text: base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
    expected = [
        (4, 1, sha("x"), "revisit", 9), (None, 1, sha("x"), "revisit", 9), (None, 5, sha("alone"), "response", None),
        (None, 3, sha("two"), "response", None), (None, 3, sha("two"), "response", None), (9, 1, sha("x"), "response", None),
    ]
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def test_records_of_other_writers(spark):
    def member(kind, block, **fields):
        lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:uuid:1-2>"]
        lines += [name.replace("_", "-").encode() + b":" + value for name, value in fields.items()]
        head = b"\r\n".join([*lines, b"Content-Length: %d" % len(block)])
        return gzip.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n")

    http = b"HTTP/1.1 200 OK\r\nServer:x\r\n\r\nbody"
    data = member(b"warcinfo", b"software: x\r\n") + member(b"response", http, WARC_Target_URI=b"http://a/") + member(b"revisit", b"")
    folder = scratch_dir(spark, "other")
    store, path = warc.store_of(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/a.warc.gz", compression=None) as out:
        out.write(data)
    archives = spark.createDataFrame([(f"{folder}/a.warc.gz", len(data))], "path string, bytes bigint")
    rows = [(r.page_id, r.payload_bytes, r.record_type, r.url) for r in warc.read_archives(archives).collect()]
    assert sorted(rows, key=str) == sorted(
        [(None, 13, "warcinfo", None), (None, 4, "response", "http://a/"), (None, None, "revisit", None)], key=str
    )
