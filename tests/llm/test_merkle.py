"""The Merkle manifest against trees that are built level by level, in memory."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(doc_id, source, lang, n_chars, text):
    values = [doc_id, source, lang, n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves):
    """The root, and each leaf's siblings as (before, after) from the leaf up."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for leaf, k in enumerate(at):
            first = k // 16 * 16
            paths[leaf].append(("".join(level[first:k]), "".join(level[k + 1 : first + 16])))
        level = [h("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        at = [k // 16 for k in at]
    return level[0], paths


def brute_report(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name, members in by_source.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(*r)))
        trees[name] = brute_tree([brute_leaf(*r) for r in members])
    root, upper = brute_tree([trees[n][0] for n in names])
    found = []
    for name, above in zip(names, upper):
        subroot, paths = trees[name]
        for row, path in zip(by_source[name], paths):
            leaf = digest = brute_leaf(*row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                digest = brute_leaf(*row[:4], text)
            for before, after in path + above:
                digest = h(before + digest + after)
            proof = h("".join(before + after for before, after in path + above))
            found.append((row[0], leaf, subroot, root, proof, digest, digest == root))
    return found


def table(sizes, seed=1):
    rng = random.Random(seed)
    rows, doc_id = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            doc_id += rng.randint(1, 3)
            text = rng.choice(["Some Text É", "lower only", "", None, "A" * 300, "ß Ä 1|2:-"])
            rows.append((doc_id, source, rng.choice(["en", None, "de"]), rng.choice([None, 7, 123]), text))
    rows += [rows[0], (None, "b", "en", 1, "No Id"), (None, "b", "en", 1, "other"), (rows[1][0], rows[1][1], "en", 3, "Twice")]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    # Names that the operator uses inside.
    for name in ("key", "number", "n", "id", "other", "block", "path", "_at"):
        docs = docs.withColumn(name, F.lit("x"))
    found = merkle.merkle_report(docs)
    assert found.columns == NAMES
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute_report(rows), key=key)


def test_report_with_production_blocks(spark):
    check(spark, table({"b": 300, None: 17, "a": 1, "": 16, "é": 33, **{f"s{i}": 2 for i in range(20)}}))


def test_report_with_many_rounds(spark, monkeypatch):
    # Blocks of 16 leaves: the largest tree takes three rounds, the sources two. Tasks read the sizes from the module
    # they import, so they are set there too.
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(merkle, "_BLOCK_BITS", 4)
    shipped = {f.__name__: f for f in (merkle._builder, merkle._hand_down, merkle._prove)}

    def small(make):
        def made(*args):
            run = make(*args)

            def task(batches):
                import tidelog.llm.merkle as module

                old = module.BLOCK_LEVELS, module._BLOCK_BITS
                module.BLOCK_LEVELS, module._BLOCK_BITS = 1, 4
                try:
                    yield from run(batches)
                finally:
                    module.BLOCK_LEVELS, module._BLOCK_BITS = old

            return task

        return made

    for name, make in shipped.items():
        monkeypatch.setattr(merkle, name, small(make))
    check(spark, table({"b": 700, None: 256, "a": 257, **{f"s{i:03}": 1 for i in range(30)}}, seed=4))


def test_empty_table(spark):
    found = merkle.merkle_report(spark.createDataFrame([], SCHEMA))
    assert found.columns == NAMES and found.count() == 0


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097, 5000])
def test_positions_are_those_of_the_completion_order(n):
    log, level = [], 0
    # A node is done when its last leaf is; nodes of one leaf's completion follow by level.
    counts = [n]
    while counts[-1] > 1:
        counts.append(-(-counts[-1] // 16))
    assert merkle.height(n) == len(counts) - 1
    for level, count in enumerate(counts):
        log += [(min((i + 1) * 16**level, n), level, i) for i in range(count)]
    for place, (_, level, i) in enumerate(sorted(log)):
        assert merkle.position(level, i, n) == place


def test_a_block_holds_its_nodes_in_completion_order():
    leaves = [h(str(i)) for i in range(40)]
    log = merkle.append_block(leaves, merkle.height(40))
    assert log[-64:] == brute_tree(leaves)[0]
    assert merkle.leaves_of(log, 0, 40) == leaves
    paths = brute_tree(leaves)[1]
    for (low, above), expected in zip(merkle.block_paths(0, 40, log), paths):
        assert [*low, *above] == [side for pair in expected for side in pair]
