"""Mixing sources to target weights by weighted fair queueing.

Each source plays its shuffled documents over and over; a document's virtual finish time is the words its source has
played up to and with it, divided by the source's target. Sorted by finish time over all sources, the mix is cut where
the total budget is spent. At any point every source has then played the same share of its target.

The order within a source and the order of the mix are total and depend on the data only. Running sums go over slices
of that order (a source of any size is many slices), with one small row per slice for what came before.

Defined cases: null texts have size 0 and are taken 0 times; a null source is one source, after all others; an empty
table gives an empty mix; rows that repeat are documents of their own, and equal ones are interchangeable; other
columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import as_rows, stored, word_count
from tidelog.operators.lookup import encoded_bytes
from tidelog.settings import broadcast_bytes

# Production parameters.
WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5  # of all sizes
MAX_EPOCHS = 2
ROWS_PER_SLICE = 20_000
BINS_PER_SLICE = 4
LEAST_BINS = 256

_HEX = 6  # digits of the shuffle order that slices are cut by: 16 million slices at most


@dataclass
class Mix:
    """What the whole table decides: per source its target, per slice its start, and where the mix ends."""

    sources: DataFrame  # source, source_no, source_size, target
    starts: DataFrame  # source, slice, before
    slices: int
    end: tuple | None  # the last copy that is taken: finish time, source_no, place


def _place(doc_id: Column) -> Column:
    """Where the shuffle puts the document: the hex digits of a hash."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def _slice(place: Column, slices: int) -> Column:
    number = F.conv(F.substring(place, 1, _HEX), 16, 10).cast("bigint")
    return F.floor(number * slices / 16**_HEX).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) gains source_no and target: shares by weight, none above epochs times its size.

    Sources are full from the smallest cap per weight upwards, so the fill level follows from running sums over that order.
    """
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    named = sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
    named = named.withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights)).cast("int"))
    ).withColumn("cap", F.col("source_size") * float(epochs))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    earlier = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * budget - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    leveled = named.withColumn("level", level)
    # The first source that its share doesn't fill sets the level of all that follow.
    open_level = F.first(
        F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level")), ignorenulls=True
    ).over(by_fill.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.coalesce(F.least(open_level * F.col("weight"), F.col("cap")), F.col("cap"))
    return leveled.select("source", "source_no", "source_size", target.alias("target"))


def _finished(rows: DataFrame, mix_sources: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows with source, place, size, slice gain played (words of the source up to and with them), target, source_no."""
    order = Window.partitionBy("source", "slice").orderBy("place", "size")
    own = rows.withColumn("within", F.sum("size").over(order))
    joined = own.join(
        starts.withColumnsRenamed({"source": "_s", "slice": "_k"}),
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("slice") == F.col("_k")),
    ).drop("_s", "_k")
    # One row per source; Spark broadcasts it below its threshold and shuffles it beyond.
    joined = joined.join(
        mix_sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    return joined.withColumn("played", F.col("before") + F.col("within"))


def _finish(epoch: int) -> Column:
    """Virtual finish time of the copy of an epoch; a source without a target never finishes."""
    return F.when(F.col("target") > 0, (F.col("played") + epoch * F.col("source_size")) / F.col("target"))


def _narrow(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.col("doc.source").alias("source"),
        word_count(F.col("doc.text")).alias("size"),
        _place(F.col("doc.doc_id")).alias("place"),
    )


def plan_mix(narrow: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = MAX_EPOCHS) -> Mix:
    """Decide the mix from a stored table of doc_id, source, size and place."""
    spark = narrow.sparkSession
    slices = max(1, -(-narrow.count() // ROWS_PER_SLICE))
    sliced = narrow.withColumn("slice", _slice(F.col("place"), slices))
    per_slice = stored(sliced.groupBy("source", "slice").agg(F.sum("size").alias("size")), "mix-slices")
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select("source", "slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    sources = stored(
        targets(per_slice.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, epochs), "mix-sources"
    )
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * budget
    played = _finished(sliced, sources, starts)
    copies = played.select(
        "size", "place", "source_no", F.explode(F.array(*[_finish(e) for e in range(epochs)])).alias("finish")
    ).filter("finish is not null and size > 0")
    bins = 4 * slices
    binned = copies.withColumn("bin", F.least(F.floor(F.col("finish") * bins), F.lit(epochs * 2 * bins)))
    running = Window.orderBy("bin")
    totals = binned.groupBy("bin").agg(F.sum("size").alias("n")).withColumn("upto", F.sum("n").over(running))
    # The bin in which the budget ends; all copies are taken if none does.
    last = totals.filter(F.col("upto") > total).orderBy("bin").select("bin", (F.col("upto") - F.col("n")).alias("before")).first()
    if last is None:
        return Mix(sources, starts, slices, (float("inf"), 0, ""))
    order = Window.orderBy("finish", "source_no", "place")
    ending = binned.filter(F.col("bin") == last["bin"]).withColumn("upto", F.sum("size").over(order) + last["before"])
    end = ending.filter(F.col("upto") <= total).orderBy(F.desc("upto"), F.desc("finish"), F.desc("source_no"), F.desc("place"))
    end = end.select("finish", "source_no", "place").first()
    if end is None:  # even the first copy of the bin is too much: all before the bin are taken
        return Mix(sources, starts, slices, (last["bin"] / bins, -1, ""))
    return Mix(sources, starts, slices, tuple(end))


def _taken(mix: Mix, epoch: int) -> Column:
    finish, source_no, place = mix.end
    tied = (F.col("source_no") < source_no) | ((F.col("source_no") == source_no) & (F.col("place") <= place))
    taken = (_finish(epoch) < finish) | ((_finish(epoch) == finish) & tied)
    return F.coalesce(taken & (F.col("size") > 0), F.lit(False))


def _copies(rows: DataFrame, mix: Mix, epochs: int) -> DataFrame:
    sliced = rows.withColumn("slice", _slice(F.col("place"), mix.slices))
    played = _finished(sliced, mix.sources, mix.starts)
    return played.withColumn("copies", sum((_taken(mix, e).cast("int") for e in range(epochs)), F.lit(0)))


def mix_report(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per row of docs: doc_id, size, source_size, target, taken (words that the mix takes of it, repeats counted)."""
    narrow = stored(_narrow(as_rows(docs)), "mix-sizes")
    mix = plan_mix(narrow, weights, budget, epochs)
    return _copies(narrow, mix, epochs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def _stretches(narrow: DataFrame, mix: Mix, epochs: int, bins: int) -> DataFrame:
    """Per source and slice its stretches of taken copies: (epoch, bin of finish times, first, last, words played before)."""
    sliced = narrow.withColumn("slice", _slice(F.col("place"), mix.slices))
    played = _finished(sliced.filter("size > 0"), mix.sources, mix.starts)
    times = F.filter(
        F.array(*[F.when(_taken(mix, e), F.struct(F.lit(e).alias("epoch"), _finish(e).alias("finish"))) for e in range(epochs)]),
        lambda t: t.isNotNull(),
    )
    copies = played.withColumn("copy", F.explode(times)).withColumn("bin", F.floor(F.col("copy.finish") * bins))
    at = F.struct("place", "size")
    found = copies.groupBy("source", "slice", "source_no", "source_size", "target", F.col("copy.epoch").alias("epoch"), "bin").agg(
        F.min(at).alias("first"), F.max(at).alias("last"), (F.max("played") - F.sum("size")).alias("start")
    )
    stretch = F.struct("epoch", "bin", "first", "last", "start")
    found = found.groupBy("source", "slice", "source_no", "source_size", "target").agg(F.collect_list(stretch).alias("stretches"))
    return stored(found, "mix-stretches")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, range-sorted by virtual finish time.

    Finish times are cut into bins. Where a source's shuffle order passes from bin to bin is known from the narrow table, so
    each row finds the bins of its copies where it is, and its text is shuffled once, to its bin, in which the exact times follow.
    """
    rows = as_rows(docs)
    narrow = stored(_narrow(rows), "mix-sizes")
    mix = plan_mix(narrow, weights, budget, epochs)
    stretches = _stretches(narrow, mix, epochs, max(LEAST_BINS, BINS_PER_SLICE * mix.slices))
    full = rows.select(
        "doc", F.col("doc.source").alias("source"), word_count(F.col("doc.text")).alias("size"),
        _place(F.col("doc.doc_id")).alias("place"),
    ).filter("size > 0")
    full = full.withColumn("slice", _slice(F.col("place"), mix.slices))
    # Some rows per slice, broadcast as long as they may be, so that the texts are not shuffled for them too.
    known = stretches.withColumnsRenamed({"source": "_s", "slice": "_k"})
    if encoded_bytes(stretches) <= broadcast_bytes(docs.sparkSession):
        known = F.broadcast(known)
    full = full.join(known, F.col("source").eqNullSafe(F.col("_s")) & (F.col("slice") == F.col("_k")))
    at = F.struct("place", "size")
    own = F.filter("stretches", lambda s: (s["first"] <= at) & (at <= s["last"]))
    copies = full.select("doc", "source_no", "source_size", "target", "place", "size", "slice", F.explode(own).alias("own"))
    copies = copies.select("*", "own.bin", "own.epoch", "own.start").drop("own").repartitionByRange("bin")
    order = Window.partitionBy("bin", "source_no", "slice", "epoch").orderBy("place", "size")
    played = F.col("start") + F.sum("size").over(order)
    timed = copies.withColumn("finish", (played + F.col("epoch") * F.col("source_size")) / F.col("target"))
    return timed.sortWithinPartitions("finish", "source_no", "place").select("doc.*")
