"""Session-level settings that the operators share."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Bytes of log that one window group may span. A hot file or table is cut into groups of this size.
CHUNK_BYTES_KEY = "spark.tidelog.chunkBytes"
CHUNK_BYTES = 64 << 20

# Largest lookup side, measured as JSON text, that may be broadcast.
BROADCAST_BYTES_KEY = "spark.tidelog.broadcastBytes"
BROADCAST_BYTES = 64 << 20

# Copies of a lookup side, and slices of a hot fact key, when the lookup is too large to broadcast.
SALTS_KEY = "spark.tidelog.salts"
SALTS = 64


def _int_setting(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def chunk_bytes(spark: SparkSession) -> int:
    return _int_setting(spark, CHUNK_BYTES_KEY, CHUNK_BYTES)


def broadcast_bytes(spark: SparkSession) -> int:
    return _int_setting(spark, BROADCAST_BYTES_KEY, BROADCAST_BYTES)


def salts(spark: SparkSession) -> int:
    return _int_setting(spark, SALTS_KEY, SALTS)


_local_scratch = False


def allow_local_scratch() -> None:
    """For samples, benches and tests: sessions on this machine without the setting may use its temporary folder."""
    global _local_scratch
    _local_scratch = True


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path below the cluster's shared `spark.checkpoint.dir`.

    A session without that setting is an error, unless it is local and allow_local_scratch() was called.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not _local_scratch or not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidelog-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Spark's own switch: a query's shuffle files go when the query ends, not when the driver's garbage collector finds them.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """For a write whose result is read from then on: its shuffle files are dropped with its end."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLES_GO) if before is None else spark.conf.set(_SHUFFLES_GO, before)
