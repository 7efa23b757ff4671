"""Line dedup of blocks of lines, against counts by hand."""

import hashlib
import random

from tidelog.llm import templates


def test_blocks_go_and_copies_stay(spark):
    rng = random.Random(8)
    block = ["Cookies are used on this site", "We share them with our partners", "You can say no to them", "Read the policy for more"]
    footer = "All rights are reserved by the owner"

    def prose():
        return [" ".join(f"w{rng.getrandbits(40):x}g".translate(str.maketrans("0123456789", "qrstuvwxyz")) for _ in range(20)) for _ in range(6)]

    rows, expected = [], {}

    def add(lines, kept):
        rows.append((len(rows), "\n".join(lines)))
        expected[len(rows) - 1] = hashlib.sha256("\n".join(kept).encode()).hexdigest()

    for _ in range(12):  # a block of lines, always in the same order
        own = prose()
        add([*block, *own], own)
    for _ in range(10):  # a footer in unrelated documents
        own = prose()
        add([*own, footer], own)
    copied, near = prose(), prose()
    for _ in range(30):  # exact copies with that footer
        add([*copied, footer], copied)
    for i in range(20):  # near copies
        own = [*near[:5], f"{near[5]} {chr(97 + i) * 3}"]
        add(own, own)
    for _ in range(7):  # one class too few
        own = ["This line is in seven documents", *prose()]
        add(own, own)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for limit in (templates.BROADCAST_TEMPLATES, 0):
        assert {r.doc_id: r.kept_sha256 for r in templates.line_dedup_report(docs, limit=limit).collect()} == expected


def test_known_templates_are_an_array_and_rows_are_cut_in_slices(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    known = np.sort(np.array([t for x in (b"one", b"two") for t in templates.line_templates(x)], np.int64))
    assert templates._among(known, [*templates.line_templates(b"two"), 5]) == set(templates.line_templates(b"two"))
    assert templates._among(known[:0], [5]) == templates._among(known, []) == set()
    monkeypatch.setattr(templates, "_AT_ONCE", 2)
    texts = [None, "", "one\nmy own", "two", "my own\n\ntwo"]
    doc = pa.array([{"doc_id": i, "text": t} for i, t in enumerate(texts)], pa.struct({"doc_id": pa.int64(), "text": pa.string()}))

    class Known:
        value = known

    # Whole rows hold their text once.
    cut = list(templates._cut_broadcast(Known, True)([pa.RecordBatch.from_arrays([doc], ["doc"])]))
    assert [b.num_rows for b in cut] == [2, 2, 1]
    found = [tuple(r.values()) for b in cut for r in b.select(["kept_text", "n_lines", "n_removed"]).to_pylist()]
    assert found == [("", 0, 0), ("", 0, 0), ("my own", 2, 1), ("", 1, 1), ("my own\n", 2, 1)]
