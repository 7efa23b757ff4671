"""Merkle manifest of a dataset as a postorder append log.

A document is a leaf. Every source is a tree of its own whose nodes hash runs of 16 children; the sources' roots are the
leaves of one more tree. Leaves get their number by a range sort and are dealt to builders in aligned blocks of 4,096:
a block is a whole subtree, so its builder appends every node when its last child is done, and its nodes are a
contiguous stretch of the tree's postorder log. A block is one row of the log. The tops of the blocks are the leaves of
the next round, until one node is left.

Where a node stands in the log follows from its level and number alone: the last leaf below it, e, comes after
e + e/16 + e/256 + ... nodes, and a node stands as many places behind its last leaf as its level says. Proofs read the
siblings at those places, from the last round down: a block hands each of its leaves the path above it.

Defined cases: a null is `-` in a leaf; leaves without doc_id come first and are not tampered with; leaves of one doc_id
are ordered by their hash; rows that repeat are leaves of their own; a null source is a source, the first; empty and
very long texts are hashed whole; an empty table has no root and gives no rows; other columns are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import in_python, stored

ARITY_BITS = 4  # runs of 16
BLOCK_LEVELS = 3  # a builder's block is a subtree of so many levels: 4,096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_IN = 5

_HEX = 64  # digits of a node
_BLOCK_BITS = ARITY_BITS * BLOCK_LEVELS
_RUN = 1 << ARITY_BITS


@dataclass
class Forest:
    """Trees that were built in step, one per key. log: per round its blocks; tops: key, top."""

    log: list[DataFrame]
    tops: DataFrame


def node(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return -(-(n - 1).bit_length() // ARITY_BITS)


def position(level: int, number: int, n: int) -> int:
    """Place of a node in the postorder log of a tree of n leaves."""
    last = min((number + 1) << (ARITY_BITS * level), n) - 1
    place = level
    while last:
        place += last
        last >>= ARITY_BITS
    return place


def _sized(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """The leaf of a document, or of the document with another text."""
    values = [text if name == "text" and text is not None else F.col(name) for name in FIELDS]
    return F.sha2(F.concat(*[_sized(v) for v in values]), 256)


def tampered_leaf() -> Column:
    """The leaf of the document with its text's A-Z lower-cased; null for documents that are left alone."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_IN == 0
    return F.when(chosen, leaf(F.translate("text", string.ascii_uppercase, string.ascii_lowercase)))


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with `key` gain their number among the key's rows in the given order, from 0, and n, how many there are.

    A range sort cuts keys of any size; each range then needs the number of the key's rows in the ranges before it.
    """
    by = [F.col("key"), *order, F.col("_tie")]
    ranges = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(ranges.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "merkle-rows")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    counts = placed.groupBy("key", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("key")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "n": F.sum("_rows").over(whole)}
    ).drop("_rows")
    found = placed.join(counts, ["key", "_range"])
    return found.withColumn("number", F.col("_before") + F.col("_at") - F.col("_first")).drop("_range", "_at", "_first", "_before")


def append_block(leaves: list[str], levels: int) -> str:
    """The log of an aligned subtree of so many levels; each node is appended once its last child is."""
    log, open_runs = [], [[] for _ in range(levels + 1)]

    def done(digest: str, level: int) -> None:
        log.append(digest)
        open_runs[level].append(digest)
        if level < levels and len(open_runs[level]) == _RUN:
            close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        done(node("".join(run)), level + 1)

    for digest in leaves:
        done(digest, 0)
    for level in range(levels):
        if open_runs[level]:
            close(level)
    return "".join(log)


def _builder(schema: pa.Schema):
    def build(batches):
        current, ids, leaves, others = None, [], [], []

        def block():
            key, number, n = current
            log = append_block(leaves, min(BLOCK_LEVELS, height(n)))
            return pa.RecordBatch.from_pylist(
                [{"key": key, "block": number, "n": n, "ids": ids, "others": others, "nodes": log, "top": log[-_HEX:]}],
                schema=schema,
            )

        for batch in batches:
            for key, number, n, one_id, digest, other in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                place = key, number, n
                if place != current:
                    if leaves:
                        yield block()
                    current, ids, leaves, others = place, [], [], []
                ids.append(one_id)
                leaves.append(digest)
                others.append(other)
        if leaves:
            yield block()

    return build


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _round(rows: DataFrame) -> DataFrame:
    """The blocks of rows with key, number, n, id, leaf, other."""
    block = F.shiftright("number", _BLOCK_BITS).alias("block")
    dealt = rows.select("key", block, "number", "n", "id", "leaf", "other").repartition("key", "block")
    ordered = dealt.sortWithinPartitions("key", "block", "number").drop("number")
    id_type = rows.schema["id"].dataType.simpleString()
    fields = [("key", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(_arrow(rows, "id")))]
    fields += [("others", pa.list_(pa.string())), ("nodes", pa.string()), ("top", pa.string())]
    columns = f"key string, block bigint, n bigint, ids array<{id_type}>, others array<string>, nodes string, top string"
    return stored(in_python(ordered, _builder(pa.schema(fields)), columns), "merkle-log")


def build(rows: DataFrame) -> Forest:
    """A tree per key over rows with key, number, n, id, leaf, other."""
    log = []
    while True:
        log.append(_round(rows))
        largest = log[-1].agg(F.max("n")).first()[0] or 0
        tops = log[-1].select("key", F.col("block").alias("number"), "top", "n")
        if largest <= 1 << _BLOCK_BITS:
            return Forest(log, tops.select("key", "top"))
        n = F.shiftright(F.col("n") - 1, _BLOCK_BITS) + 1
        rows = tops.select(
            "key", "number", n.alias("n"), F.col("number").alias("id"), F.col("top").alias("leaf"),
            F.lit(None).cast("string").alias("other"),
        )


def block_paths(block: int, n: int, nodes: str):
    """For each leaf of a block, its siblings level by level: what stands before and after it in its run."""
    start = block << _BLOCK_BITS
    count = min(n - start, 1 << _BLOCK_BITS)
    first = position(0, start, n)
    levels = min(BLOCK_LEVELS, height(n))

    def run(level: int, parent: int) -> str:
        end = min((parent + 1) << ARITY_BITS, -(-n >> (ARITY_BITS * level)))
        places = [position(level, child, n) - first for child in range(parent << ARITY_BITS, end)]
        return "".join([nodes[p * _HEX : (p + 1) * _HEX] for p in places])

    def sides(level: int, number: int, text: str) -> list[str]:
        own = (number & (_RUN - 1)) * _HEX
        return [text[:own], text[own + _HEX :]]

    runs: dict[tuple[int, int], str] = {}
    for first_leaf in range(start, start + count, _RUN):
        above = []
        for level in range(1, levels):
            number = first_leaf >> (ARITY_BITS * level)
            place = level, number >> ARITY_BITS
            if place not in runs:
                runs[place] = run(*place)
            above += sides(level, number, runs[place])
        text = run(0, first_leaf >> ARITY_BITS) if levels else ""
        for leaf_no in range(first_leaf, min(first_leaf + _RUN, start + count)):
            yield (sides(0, leaf_no, text) if levels else []), above


def leaves_of(nodes: str, block: int, n: int) -> list[str]:
    start = block << _BLOCK_BITS
    first = position(0, start, n)
    places = [position(0, i, n) - first for i in range(start, min(start + (1 << _BLOCK_BITS), n))]
    return [nodes[p * _HEX : (p + 1) * _HEX] for p in places]


def fold(digest: str, path: list[str]) -> str:
    """The node that the path leads to from a digest."""
    for before, after in zip(path[::2], path[1::2]):
        digest = node(before + digest + after)
    return digest


_PATH_ROWS = 512


def _hand_down(schema: pa.Schema):
    """Blocks with the path above them (key, block, n, ids, nodes, subroot, path) to the paths of their leaves."""

    def hand(batches):
        for batch in batches:
            for row in batch.to_pylist():
                paths = [[*low, *above, *row["path"]] for low, above in block_paths(row["block"], row["n"], row["nodes"])]
                for i in range(0, len(paths), _PATH_ROWS):
                    part = paths[i : i + _PATH_ROWS]
                    same = [row["key"]] * len(part), [row["subroot"]] * len(part)
                    columns = [same[0], row["ids"][i : i + _PATH_ROWS], same[1], part]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return hand


def _prove(schema: pa.Schema, root: str):
    """Blocks of documents with the path above them to one row per document."""

    def prove(batches):
        for batch in batches:
            for row in batch.to_pylist():
                upper, digests = row["path"], leaves_of(row["nodes"], row["block"], row["n"])
                columns = [[] for _ in schema.names]
                folded: dict[tuple[int, str], str] = {}
                shared, rest = None, ""
                paths = block_paths(row["block"], row["n"], row["nodes"])
                for i, (own_id, digest, other, (low, above)) in enumerate(zip(row["ids"], digests, row["others"], paths)):
                    if above is not shared:  # the same for a run
                        shared, rest = above, "".join(above) + "".join(upper)
                    start = fold(other or digest, low)
                    place = i >> ARITY_BITS, start
                    if place not in folded:
                        folded[place] = fold(start, [*above, *upper])
                    found = folded[place]
                    values = own_id, digest, row["subroot"], root, node("".join(low) + rest), found, found == root
                    for column, value in zip(columns, values):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return prove


def _above(block_rows: DataFrame, paths: DataFrame) -> DataFrame:
    """Each block with the path of its top: paths has key, id (the block's number), subroot, path."""
    return block_rows.join(paths.withColumnRenamed("id", "block"), ["key", "block"])


def _paths_of(forest: Forest, top_paths: DataFrame, down_to: int) -> DataFrame:
    """From the paths of the tops (key, subroot, path) to those of the leaves of round down_to: key, id, subroot, path."""
    paths = top_paths.withColumn("id", F.lit(0).cast("bigint"))
    for blocks in reversed(forest.log[down_to:]):
        id_type = blocks.schema["ids"].dataType.elementType.simpleString()
        fields = [("key", pa.string()), ("id", pa.string() if id_type == "string" else pa.int64()), ("subroot", pa.string())]
        rows = _above(blocks.select("key", "block", "n", "ids", "nodes"), paths)
        schema = pa.schema([*fields, ("path", pa.list_(pa.string()))])
        paths = stored(
            in_python(rows, _hand_down(schema), f"key string, id {id_type}, subroot string, path array<string>"), "merkle-paths"
        )
    return paths


def merkle_report(docs: DataFrame) -> DataFrame:
    """Build the manifest of all documents, extract each one's proof and verify it after tampering.

    Per document: doc_id, leaf, subroot, root, proof_sha256 (of its siblings from the leaf up), folded_root, verified.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    columns = (
        f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    rows = docs.select(
        _sized(F.col("source")).alias("key"), F.col("doc_id").alias("id"), leaf().alias("leaf"), tampered_leaf().alias("other")
    )
    by_id = numbered(rows, [F.col("id"), F.col("leaf")])
    sources = build(by_id)

    # The sources' tops are the leaves of the last tree, in the order of their names.
    name = F.when(F.col("key") != "-", F.expr("substring(key, instr(key, ':') + 1)"))
    tops = sources.tops.select(
        F.lit("").alias("key"), F.col("key").alias("id"), name.alias("name"), F.col("top").alias("leaf"),
        F.lit(None).cast("string").alias("other"),
    )
    whole = build(numbered(tops, [F.col("name")]).drop("name"))
    found = whole.tops.first()
    if found is None:
        return docs.sparkSession.createDataFrame([], columns)
    top = whole.tops.select("key", F.lit("").alias("subroot"), F.array().cast("array<string>").alias("path"))
    by_source = _paths_of(whole, top, 0).select(F.col("id").alias("key"), "path")
    by_source = by_source.join(sources.tops.withColumnRenamed("top", "subroot"), "key").select("key", "subroot", "path")

    blocks = sources.log[0].select("key", "block", "n", "ids", "others", "nodes")
    with_path = _above(blocks, _paths_of(sources, by_source, 1))
    fields = [("doc_id", _arrow(docs, "doc_id")), *[(c, pa.string()) for c in ("leaf", "subroot", "root")]]
    fields += [("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())]
    return in_python(with_path, _prove(pa.schema(fields), found["top"]), columns)
