"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The change log is landed once before the clock starts, as a capture agent would leave it. Each figure is the median of
three runs, planning included; results go to a sink that only consumes rows, or to files where writing is the point.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import log as L  # noqa: E402
from samples import queries as Q  # noqa: E402
from samples.sql import NOW_TS, REPLAY, SINCE, UNTIL  # noqa: E402
from tidelog.operators.ids import assign_ids  # noqa: E402
from tidelog.operators.resolve import drop_bad_rows, explode_rows, resolve_tables  # noqa: E402
from tidelog.operators.seek import seek_positions  # noqa: E402
from tidelog.plans.capture import capture, numbered_capture, replay_since  # noqa: E402
from tidelog.plans.export import export_events  # noqa: E402
from tidelog.plans.inventory import log_inventory  # noqa: E402
from tidelog.settings import scratch_dir  # noqa: E402
from tidelog.sinks.change_log import change_log_lines  # noqa: E402
from tidelog.sinks.event_store import FULL, append_events, append_numbered  # noqa: E402
from tidelog.sinks.export import export_csv, export_json  # noqa: E402
from tidelog.sources.event_store import read_event_store  # noqa: E402
from tidelog.streaming.capture import capture_stream, table_sink  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    events = L.row_events(spark, SF_DIR)
    columns, keys = Q._catalogs(spark, SF_DIR)
    store_path = scratch_dir(spark, "store")
    append_events(capture(events, columns, keys), store_path, FULL)
    store = read_event_store(spark, store_path)
    instants = L.load(spark, SF_DIR, "events").select(L.unix_seconds("ts").alias("target_ts"))
    one = instants.agg(F.max("target_ts").alias("target_ts"))

    def rows():
        return drop_bad_rows(explode_rows(resolve_tables(events)))

    def stream():
        query = capture_stream(
            events_stream(), columns, keys, table_sink(scratch_dir(spark, "events")), scratch_dir(spark, "stream"),
            trigger={"availableNow": True},
        )
        query.awaitTermination()

    def events_stream():
        return spark.readStream.schema(events.schema).parquet(L._landed[(spark.sparkContext.applicationId, SF_DIR)])

    timed = {
        "capture": lambda: consume(capture(events, columns, keys)),
        "capture_filtered": lambda: consume(capture(events, columns, keys, "app_*", "c*k")),
        "change_log_lines": lambda: consume(change_log_lines(capture(events, columns, keys))),
        "resolve_tables": lambda: consume(resolve_tables(events)),
        "seek_one": lambda: consume(seek_positions(events, one)),
        "seek_all_events": lambda: consume(seek_positions(events, instants)),
        "replay_since": lambda: consume(replay_since(events, columns, keys, since=REPLAY)),
        "log_inventory": lambda: consume(log_inventory(events, NOW_TS, SINCE, UNTIL)),
        "assign_ids": lambda: consume(assign_ids(rows())),
        "append_full": lambda: append_numbered(*numbered_capture(events, columns, keys), scratch_dir(spark, "store"), FULL),
        "export_csv": lambda: export_csv(export_events(store), scratch_dir(spark, "csv")),
        "export_json": lambda: export_json(export_events(store), scratch_dir(spark, "json")),
        "export_limit": lambda: consume(export_events(store, operation="INSERT", limit=20000)),
        "stream_capture": stream,
    }
    results = {}
    for name, run in timed.items():
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - start)
        results[name] = round(statistics.median(seconds), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "change feed queries, total of medians",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
