"""What must hold for queries to grow with their input: work per table or per header, and no narrow places."""

from conftest import plan_of
from pyspark.sql import functions as F
from samples import log as L
from samples import queries as Q

from tidelog.functions import render as R
from tidelog.operators import seek
from tidelog.operators.asof import asof_join
from tidelog.operators.resolve import drop_bad_rows, explode_rows, resolve_tables
from tidelog.sources.files import names_in


def test_row_image_quotes_names_once(spark):
    cells = "array(named_struct('kind', 'int', 'b', binary(''), 'i', 7L, 'u', 1bd, 'f', 1f, 'd', 1d, 'dt', null, 'tm', null, 'raw', ''))"
    kind = L._ROWS.elementType["after"].dataType
    df = spark.range(1).select(F.expr(cells).cast(kind).alias("cells"), F.array(F.lit('a"')).alias("names"))
    found = df.select(R.row_image_json(F.col("cells"), F.col("names")).alias("row"))
    assert found.first()["row"] == '{"a\\"":7}'
    # One quoting of the names, not one per cell and use.
    assert found._jdf.queryExecution().analyzed().toString().count("transform(names") == 1


def test_queries_quote_names_once_per_table(spark, sf):
    plan = Q.q_row_image_json(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    top = plan[: plan.index("Join")]
    assert "name_keys" in top and "transform(columns" not in top


def test_log_is_put_in_order_without_its_rows(spark, sf):
    assert "rows" not in L._headers(spark, sf).columns
    landed, derived = L.row_events(spark, sf), L.derive_row_events(spark, sf)
    order = ["file_no", "start_pos", "event_type"]
    names = derived.columns
    assert landed.select(*names).orderBy(*order).collect() == derived.orderBy(*order).collect()


def test_log_lands_in_parts_of_many_log_files(spark):
    log = L.row_events(spark, "/root/testdata/sf0.01")
    files = log.inputFiles()
    assert not any("file_no=" in f for f in files)
    assert 1 < len(files) <= 2 * spark.sparkContext.defaultParallelism
    # In log order: each part has log positions of its own.
    place = F.struct("file_no", "start_pos")
    bounds = log.groupBy(F.input_file_name().alias("part")).agg(F.min(place).alias("low"), F.max(place).alias("high"))
    found = sorted((tuple(r["low"]), tuple(r["high"])) for r in bounds.collect())
    assert all(before[1] < after[0] for before, after in zip(found, found[1:]))


def test_maps_are_gathered_once(spark, sf):
    """The plan of a resolution reads the bindings that its tests read, and scans the log for the rows events only."""
    plan = resolve_tables(L.row_events(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert "TABLE_MAP" not in plan and plan.count("Relation") == 2


def test_streams_land_in_as_many_files_as_the_log_is_read_in(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4m")
    try:
        landed, files = Q._landed(spark, "/root/testdata/sf0.01")
    finally:
        spark.conf.set(key, before)
    assert files > 2
    assert sum(n.startswith("part-") for n in names_in(spark, landed)) == 2 * files


def test_dozens_of_points_need_no_folders(spark):
    facts = spark.range(2000).select(F.lit(1).cast("bigint").alias("file_no"), F.col("id").alias("start_pos"))
    points = spark.range(0, 2000, 50).select(F.lit(1).cast("bigint").alias("file_no"), F.col("id").alias("from_pos"), F.col("id").alias("at"))
    found = asof_join(facts, points, ["file_no"], ["at"])
    assert "Arrow" not in plan_of(found)
    assert {(r["start_pos"], r["at"]) for r in found.collect()} == {(n, (n - 1) // 50 * 50) for n in range(1, 2000)}


def test_positions_are_shuffled_beyond_a_few(spark, sf, monkeypatch):
    few = {tuple(r) for r in Q.q_resolve_start(spark, sf).collect()}
    monkeypatch.setattr(seek, "_FEW_POSITIONS", 0)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        many = Q.q_resolve_start(spark, sf)
        assert "BroadcastHashJoin" not in plan_of(many)
        assert {tuple(r) for r in many.collect()} == few
    finally:
        spark.conf.set(threshold, before)


def test_counting_captured_rows_reads_no_cells(spark, sf):
    """An append counts what it numbers; that needs the rows' error texts only."""
    events = Q._captured(spark, sf)
    plan = events.groupBy("file_no").count()._jdf.queryExecution().executedPlan().toString()
    assert "rows:array<struct<error:" in plan and "struct<before" not in plan
    assert events.count() == drop_bad_rows(explode_rows(resolve_tables(L.row_events(spark, sf)))).count()


def test_log_is_made_from_one_scan(spark, sf):
    plan = L.derive_row_events(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
