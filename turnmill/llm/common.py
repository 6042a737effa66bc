"""Helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.session import save_step, step_path

SPACE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
WORD = r"[^\x20\x09-\x0D]+"
SLICE = 1 << 22  # bytes of a text that are handled together


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def tasks(spark: SparkSession) -> int:
    """Tasks of a step whose work per byte is high: counted, not sized."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written once, every row with a ``rid`` of its own.

    Rows may repeat and keys may be null; later joins go by ``rid``, which is
    fixed because it is written and never computed again.
    """
    return save_step(docs.withColumn("rid", F.monotonically_increasing_id()), name)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for files in the shared folder, as a path or URI."""
    folder = step_path(spark, name)
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    return folder


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI, or of an absolute path, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri)


def slices(data: bytes | str, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Parts of a text of about ``size`` bytes or characters, each cut at a blank if one follows."""
    start, blank = 0, " " if isinstance(data, str) else b" "
    while start < len(data):
        end = data.find(blank, start + size)
        end = len(data) if end < 0 else end
        yield start, end
        start = end


def each(column: pa.Array) -> Iterator:
    """The values of a column one by one: a batch of texts is not held twice."""
    return (value.as_py() for value in column)
