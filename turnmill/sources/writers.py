"""Sinks. Every output is a directory of part files written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.operators.formats import record_lines, to_format
from turnmill.session import save_step

SPLIT_FORMATS = ("jsonl", "json", "csv")


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines in UTF-8; NULL fields are written out, raw samples as they are."""
    if df.columns == ["sample"]:
        df.write.mode(mode).text(path)
    else:
        df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON data as a JSON Lines directory: one big array cannot be written in parallel."""
    write_jsonl(df, path, mode)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header; nested columns become JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [
        F.to_json(F.col(f"`{f.name}`"), {"ignoreNullFields": "false"}).alias(f.name)
        if isinstance(f.dataType, nested)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode(mode).csv(
        path,
        header=True,
        escape='"',
        quote='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def save_split(split: DataFrame, path: str, fmt: str = "jsonl", mode: str = "errorifexists") -> None:
    """Write a split frame once, as ``split=train`` and ``split=test`` folders."""
    if fmt not in SPLIT_FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    writer = split.write.mode(mode).partitionBy("split")
    if fmt == "csv":
        writer.csv(
            path,
            header=True,
            escape='"',
            quote='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    else:
        writer.option("ignoreNullFields", "false").json(path)


def save_results(
    records: DataFrame, metadata: DataFrame, out: str, mode: str = "errorifexists"
) -> dict[str, str]:
    """Write the result bundle: records per split, metadata, and train export layouts.

    The records are materialised once; all five outputs read that table.
    """
    return write_bundle(save_step(records, "records"), metadata, out, mode)


def write_bundle(
    records: DataFrame, metadata: DataFrame, out: str, mode: str = "errorifexists"
) -> dict[str, str]:
    """The result bundle of records that are already a table."""
    train = records.filter(F.col("split") == "train").drop("split")
    test = records.filter(F.col("split") == "test").drop("split")
    # Names of the outputs.
    paths = {
        "train": f"{out}/sft_train_data.jsonl",
        "test": f"{out}/sft_test_data.jsonl",
        "metadata": f"{out}/generation_metadata.json",
        "alpaca_train": f"{out}/alpaca_train_data.json",
        "sharegpt_train": f"{out}/sharegpt_train_data.json",
    }
    write_jsonl(record_lines(train), paths["train"], mode)
    write_jsonl(record_lines(test), paths["test"], mode)
    write_json(metadata, paths["metadata"], mode)
    write_json(to_format(train, "alpaca"), paths["alpaca_train"], mode)
    write_json(to_format(train, "sharegpt"), paths["sharegpt_train"], mode)
    return paths


def save_summary(summary: DataFrame, out: str, mode: str = "errorifexists") -> str:
    """Write the one-row run summary."""
    path = f"{out}/pipeline_summary.json"
    write_json(summary, path, mode)
    return path
