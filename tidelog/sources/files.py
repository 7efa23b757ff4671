"""Small files and folders in the store that the cluster shares, through Hadoop's file systems."""

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tidelog.settings import scratch_dir


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _at(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it."""
    place, store = _at(spark, path)
    store.delete(place, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of what is in a folder; none if there is no folder."""
    place, store = _at(spark, folder)
    if not store.exists(place):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    place, store = _at(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, over any that is there."""
    place, store = _at(spark, path)
    stream = store.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole under a name that nobody else has taken; False, and nothing written, if somebody has.

    The text goes to a file of its own first, which then gets the name in one step: a link on a local disk, elsewhere a
    rename that refuses to replace (one step on HDFS; object stores need a committer that offers the same).
    """
    jvm = spark._jvm
    place, store = _at(spark, path)
    store.mkdirs(place.getParent())
    draft, _ = _at(spark, f"{os.path.dirname(path)}/.draft-{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if store.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), place.toUri().getPath())
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(draft, place, none)
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        if store.exists(draft):
            store.delete(draft, False)
    return True


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the shared folder: what follows reads it and never computes it again."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
