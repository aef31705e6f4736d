"""Word count over free text.

Words are maximal runs of ``[a-z0-9]`` after lower-casing. The split and
explode stay JVM-side; the count is a hash aggregation with partial
aggregation, so a word that is a third of all words is summed map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What separates words.
WORD_SEPARATOR = "[^a-z0-9]+"


def words(texts: DataFrame, column: str = "text") -> DataFrame:
    """One row per word occurrence (column ``word``)."""
    tokens = F.explode(F.split(F.lower(F.col(column)), WORD_SEPARATOR)).alias("word")
    return texts.select(tokens).where(F.col("word") != "")


def word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of every word (word, count)."""
    return words(texts, column).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
