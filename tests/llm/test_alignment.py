"""Alignment of two tokenizers against whole encodings and a plain loop over all pairs of tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm import alignment

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SCHEMA = "doc_id bigint, text string, batch string, a int, b int, n int, counts string, at int"


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def spans(ids, data):
    found, at = [], 0
    for i, raw in zip(ids, data):
        found.append((i, at, at + len(raw)))
        at += len(raw)
    return found


def brute(rows, encoders):
    a, b = encoders
    letters = alignment.byte_alphabet()
    docs = []
    for doc_id, text in rows:
        own = None
        if text:
            a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            a_raw = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
            b_raw = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in b_ids for p in [b.id_to_piece(i)]]
            if b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
                own = spans(a_ids, a_raw), spans(b_ids, b_raw)
        docs.append((doc_id, own))
    linked = []
    for _, own in docs:
        if own is None:
            linked.append([])
        else:
            linked.append([(x, y) for x, s, e in own[0] for y, t, f in own[1] if s < f and t < e])
    counts = Counter(pair for links in linked for pair in links)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    found = []
    for (doc_id, own), links in zip(docs, linked):
        if own is None:
            found.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = sorted({e for _, _, e in own[0]} & {e for _, _, e in own[1]})
        groups, start = [], 0
        for cut in cuts:
            sides = [",".join(str(i) for i, _, e in side if start < e <= cut) for side in own]
            groups.append("|".join(sides))
            start = cut
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        best = sum(counts[p] == most[p[1]] for p in links)
        found.append((doc_id, len(own[0]), len(own[1]), len(groups), len(links), best, sum(counts[p] for p in links), sha))
    return found


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a   b  ", "\ta b\t", "x▁y z", "▁", "<|endoftext|> <s> </s> <0x41> <unk>",
    "don't we'll I'M 12.5% $$$", "naïve café ÀÉÎ ßüö", "日本語 テキスト", "🙂🙃 ok", "a b   c", "é combining", "tab\tword\x0b\x1c x", "a\x00b c",
    "line one\nline two\n\nline three", "one " * 40, "supercalifragilistic" * 12, "　 wide  space", "᠎ x ​ y", "a\r\n b",
]


def table(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéfghi") for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["the", "and", "don't", "12,5", "\n"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 50))) for _ in range(30)]
    texts += ODD + [texts[0], texts[0] + "  " + texts[1]]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[2], (None, texts[3]), (2, texts[4])]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "c", 4) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("piece, batch_links", [(alignment.PIECE, alignment.BATCH_LINKS), (7, 50)])
def test_against_brute_force(spark, encoders, piece, batch_links):
    rows = table()
    found = alignment.alignment_report(frame(spark, rows), piece=piece, batch_links=batch_links)
    assert sorted(found.columns) == sorted(NAMES)
    assert in_order(found.select(*NAMES).collect()) == in_order(brute(rows, encoders))


def test_texts_longer_than_a_lot(encoders, monkeypatch):
    monkeypatch.setattr(alignment, "LOT_CHARS", 60)
    monkeypatch.setattr(alignment.segments, "__defaults__", (60,))
    monkeypatch.setattr(alignment, "KNOWN_CHUNKS", 20)
    rows = [(i, t) for i, (_, t) in enumerate(table(6))]
    batch = alignment.Batch((alignment.TOKENIZER_A, alignment.TOKENIZER_B), 11)
    for row in rows:
        batch.add(*row)
    got = batch.row(0)
    expected = brute(rows, encoders)
    for k, name in enumerate(["n_a", "n_b", "n_groups", "n_links"], 1):
        assert got[name].tolist() == [r[k] for r in expected]
    assert got["groups_sha256"] == [r[-1] for r in expected]
    assert int(got["n"].sum()) == sum(r[4] for r in expected)


def test_empty_table(spark):
    assert alignment.alignment_report(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert in_order(alignment.alignment_report(nothing).select(*NAMES).collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


@pytest.mark.parametrize("piece", [1, 2, 3, 10, 1000])
def test_pieces_give_the_whole_merge(piece):
    rng = random.Random(piece)
    for _ in range(30):
        total = rng.randint(1, 60)
        a_ends = np.array(sorted({*rng.sample(range(1, total + 1), rng.randint(0, total)), total}))
        b_ends = np.array(sorted({*rng.sample(range(1, total + 1), rng.randint(0, total)), total}))
        links, a_cut, b_cut = [], np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
        for in_a, in_b, cut_a, cut_b, (i0, i1, j0, j1) in alignment.merged(a_ends, b_ends, piece):
            assert (i1 - i0) + (j1 - j0) <= piece
            links += zip(in_a.tolist(), in_b.tolist())
            a_cut[i0:i1], b_cut[j0:j1] = cut_a, cut_b
        both = set(a_ends.tolist()) & set(b_ends.tolist())
        assert a_ends[a_cut].tolist() == b_ends[b_cut].tolist() == sorted(both)
        a_spans = list(zip([0, *a_ends[:-1]], a_ends))
        b_spans = list(zip([0, *b_ends[:-1]], b_ends))
        expected = [(i, j) for i, (s, e) in enumerate(a_spans) for j, (t, f) in enumerate(b_spans) if s < f and t < e]
        assert sorted(links) == expected


def test_the_driver_tables_as_whole_encodings(spark, sf, encoders):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter(F.length("text") < 2000)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert in_order(alignment.alignment_report(docs).select(*NAMES).collect()) == in_order(brute(rows, encoders))
