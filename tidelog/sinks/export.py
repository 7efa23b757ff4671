"""Exports of the event store as JSON lines or CSV."""

from pyspark.sql import DataFrame


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, null columns included; JSON held in text columns stays text."""
    df.write.option("ignoreNullFields", "false").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    r"""Header and rows with `\n` line ends.

    A field is quoted only when it needs to be, quotes are doubled, null and empty text both give the empty field.
    """
    df.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        lineSep="\n",
    )
