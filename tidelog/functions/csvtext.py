"""CSV text of single fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def csv_field(value: Column) -> Column:
    """A field quoted only when it holds a comma, a quote or a line break; null is the empty field."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[,"\n\r]'), quoted).otherwise(text)
