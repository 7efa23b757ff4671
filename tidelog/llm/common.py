"""What the operators of this subpackage share: word rules, scratch tables, and the documents table as rows."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.settings import broadcast_bytes, scratch_dir, shuffles_dropped
from tidelog.sources.files import remove

# The six ASCII characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The maximal runs of characters other than SPACES, in order; none for a null text."""
    text = F.coalesce(text, F.lit(""))
    # translate() walks a map per character; most texts hold only blanks and line ends.
    plain = F.when(text.rlike(r"[\x09\x0B-\x0D]"), F.translate(text, SPACES, " " * len(SPACES))).otherwise(
        F.replace(text, F.lit("\n"), F.lit(" "))
    )
    return F.array_remove(F.split(plain, " "), "")


def word_count(text: Column) -> Column:
    """How many words the text has; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def as_rows(docs: DataFrame) -> DataFrame:
    """The table with each row as one column `doc`, so that own columns clash with none of the table's."""
    return docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))


# The folders of the tables that were stored within the innermost `settled`.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the cluster's shared folder: later steps read it and never compute it again."""
    path = scratch_dir(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What `make` gives as a stored table. The tables that were stored on the way to it are deleted, as nothing else reads them."""
    token = _passing.set([])
    try:
        made = make()
        found = stored(made, label)
        *passed, kept = _passing.get()
    finally:
        _passing.reset(token)
    for path in passed:
        remove(made.sparkSession, path)
    if (passing := _passing.get()) is not None:
        passing.append(kept)
    return found


def small(rows: DataFrame, row_bytes: int) -> bool:
    """Whether a stored table of rows of about that size may be broadcast."""
    return rows.count() * row_bytes <= broadcast_bytes(rows.sparkSession)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def in_python(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow with this package sent to the executors, so that none needs it installed."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        code = Path(tempfile.mkdtemp(prefix="code-"), f"{root.name}.zip")
        with zipfile.ZipFile(code, "w") as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, file.relative_to(root.parent))
        context.addPyFile(str(code))
        _shipped.add(context.applicationId)
    return df.mapInArrow(function, schema)
