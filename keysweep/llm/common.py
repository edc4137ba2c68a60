"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.session import scratch_path

# White space that separates words: U+0020 and U+0009 to U+000D.
WORD_SEPARATOR = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def whole_text(column: str = "text") -> Column:
    """The text, a null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_array(text: Column) -> Column:
    """Words of a text, in order, as an array of strings."""
    return F.array_remove(F.split(text, WORD_SEPARATOR), "")


def pinned(column: Column) -> Column:
    """``column``, whose definition Catalyst must not copy into a filter above.

    A filter on a computed column is pushed below its projection by writing the
    whole definition into the filter; with array functions over a text that
    would split the text again for every word. A condition that reads the row
    number (always true) keeps the filter where it stands.
    """
    return F.when(F.monotonically_increasing_id() >= 0, column)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the session's shared checkpoint folder and read again.

    Used where a result is read more than once, or where a loop would grow the
    lineage: the files survive the loss of any executor.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
