"""Filters over whole samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.functions.samples import with_validity
from turnmill.functions.text import content_hash


def keep_valid(df: DataFrame, sample: str = "sample") -> DataFrame:
    """Only the usable samples."""
    flagged = with_validity(df, sample, "_valid")
    # A filter would be pushed below the parsing and repeat it; a generator is not.
    once = F.explode(F.when(F.col("_valid"), F.array(F.lit(True))))
    return flagged.withColumn("_once", once).drop("_valid", "_once")


def drop_exact_duplicates(df: DataFrame, text: str = "text", key: str = "pos") -> DataFrame:
    """The first row, by ``key``, of every distinct text.

    The minimum is taken map-side, so a text shared by a third of all rows
    travels as one small row per task; whole rows move only by their own key.
    """
    first = df.groupBy(content_hash(F.col(text)).alias("_hash")).agg(F.min(key).alias(key))
    return df.join(first.select(key), key, "left_semi")
