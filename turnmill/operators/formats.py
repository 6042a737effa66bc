"""Nested training records and the common export layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.functions.samples import has, parse

EXCHANGES = "array<struct<instruction:string,input:string,output:string>>"
FORMATS = ("alpaca", "sharegpt", "chatglm")


def training_records(results: DataFrame) -> DataFrame:
    """Successful result rows as nested records; ``original_data`` is kept if present."""
    turns = F.transform(
        "turns",
        lambda t: F.struct(
            F.coalesce(t["prompt"], F.lit("")).alias("instruction"),
            F.coalesce(t["response"], F.lit("")).alias("output"),
            F.lit("").alias("input"),
            F.struct(
                F.coalesce(t["round"], F.lit(1)).alias("round"),
                F.coalesce(t["client"], F.lit("unknown")).alias("api_client"),
                t["timestamp"].alias("timestamp"),
            ).alias("metadata"),
        ),
    )
    summary = F.struct(
        "success", "processing_time", "api_client_used", F.size("turns").alias("num_turns")
    )
    made = {"turns", "success", "error_message", "processing_time", "api_client_used"}
    rest = [c for c in results.columns if c not in made]
    return results.filter("success").select(
        *rest, turns.alias("conversations"), summary.alias("generation_metadata")
    )


def with_original(samples: DataFrame, derived: tuple[str, ...] = ("prompt", "_source")) -> DataFrame:
    """Samples with ``original_data``: the JSON text of the sample as it was given.

    That is the column of this name, else ``sample``, else an object of all columns
    but the derived ones and ``split``. Raw columns that this replaces are dropped.
    """
    if "original_data" in samples.columns:
        given, gone = F.col("original_data"), derived
    elif "sample" in samples.columns:
        given, gone = F.col("sample"), (*derived, "sample")
    else:
        own = [c for c in samples.columns if c not in (*derived, "split")]
        fields = F.struct(*[F.col(f"`{c}`") for c in own])
        given, gone = F.to_json(fields, {"ignoreNullFields": "false"}), derived
    return samples.withColumn("original_data", given).drop(*gone)


def record_lines(records: DataFrame) -> DataFrame:
    """Nested records as JSON lines of conversations, original data and metadata.

    The original data is an object again, its keys in their own order; line breaks
    between its values become spaces.
    """
    whole = {"ignoreNullFields": "false"}
    original = F.lit("null")
    if "original_data" in records.columns:
        original = F.coalesce(F.translate("original_data", "\r\n", "  "), original)
    line = F.concat(
        F.lit('{"conversations":'),
        F.to_json("conversations", whole),
        F.lit(',"original_data":'),
        original,
        F.lit(',"generation_metadata":'),
        F.to_json("generation_metadata", whole),
        F.lit("}"),
    )
    return records.select(line.alias("sample"))


def _one(instruction: Column, given: Column, output: Column) -> Column:
    return F.array(
        F.struct(
            instruction.alias("instruction"), given.alias("input"), output.alias("output")
        )
    ).cast(EXCHANGES)


def _original_exchange(original: Column) -> Column:
    parsed = parse(original)
    return F.when(
        has(parsed, "question", "answer"),
        _one(
            F.try_variant_get(parsed["question"], "$", "string"),
            F.lit(""),
            F.try_variant_get(parsed["answer"], "$", "string"),
        ),
    )


def exchanges(df: DataFrame) -> Column:
    """What a typed row says, as instruction/input/output exchanges.

    Its conversations if there are any, else its own instruction and output,
    else question and answer of ``original_data``; NULL if nothing applies.
    """
    columns, options = set(df.columns), []
    if "conversations" in columns:
        said = F.transform(
            "conversations",
            lambda c: F.struct(c["instruction"], c["input"], c["output"]),
        ).cast(EXCHANGES)
        options.append(F.when(F.size("conversations") > 0, said))
    if {"instruction", "output"} <= columns:
        given = F.col("input") if "input" in columns else F.lit("")
        options.append(_one(F.col("instruction"), given, F.col("output")))
    elif "original_data" in columns:
        options.append(_original_exchange(F.col("original_data")))
    return F.coalesce(*options) if options else F.lit(None).cast(EXCHANGES)


def sample_exchanges(sample: Column) -> Column:
    """The same for one raw JSON sample, where key presence decides."""
    parsed = parse(sample)

    def text(holder: Column, path: str) -> Column:
        return F.try_variant_get(holder, path, "string")

    def holds(item: Column, key: str) -> Column:
        return F.array_contains(F.json_object_keys(F.to_json(item)), key)

    def entry(item: Column, key: str) -> Column:
        return F.when(holds(item, key), text(item, f"$.{key}")).otherwise(F.lit(""))

    items = F.try_variant_get(parsed["conversations"], "$", "array<variant>")
    said = F.transform(
        items,
        lambda c: F.struct(
            entry(c, "instruction").alias("instruction"),
            entry(c, "input").alias("input"),
            entry(c, "output").alias("output"),
        ),
    ).cast(EXCHANGES)
    given = F.when(has(parsed, "input"), text(parsed["input"], "$")).otherwise(F.lit(""))
    own = _one(text(parsed["instruction"], "$"), given, text(parsed["output"], "$"))
    original = parsed["original_data"]
    question, answer = text(original, "$.question"), text(original, "$.answer")
    return (
        F.when(F.size(items) > 0, said)
        .when(has(parsed, "instruction", "output"), own)
        .when(
            holds(original, "question") & holds(original, "answer"),
            _one(question, F.lit(""), answer),
        )
    )


def to_format(
    df: DataFrame, name: str = "alpaca", sample: str | None = None, key: str | None = None
) -> DataFrame:
    """Rows in an export layout; rows with nothing to export are dropped.

    Works on typed rows, or on raw JSON when ``sample`` names its column. An
    unknown layout returns the rows unchanged. ``key`` keeps that column too.
    """
    if name not in FORMATS:
        return df
    said = sample_exchanges(F.col(sample)) if sample else exchanges(df)
    kept = [F.col(key)] if key else []
    if sample:
        ident = F.coalesce(F.get_json_object(sample, "$.id"), F.lit(""))
    elif "id" in df.columns:
        ident = F.coalesce(F.col("id").cast("string"), F.lit(""))
    else:
        ident = F.lit("")
    rows = df.select(*kept, said.alias("_said"), ident.alias("_id")).filter("_said IS NOT NULL")
    first = F.get("_said", F.lit(0))
    if name == "alpaca":
        return rows.select(
            *kept,
            first["instruction"].alias("instruction"),
            first["input"].alias("input"),
            first["output"].alias("output"),
        )
    if name == "chatglm":
        return rows.select(
            *kept,
            first["instruction"].alias("prompt"),
            first["output"].alias("response"),
            F.array().cast("array<string>").alias("history"),
        )
    voices = F.flatten(
        F.transform(
            "_said",
            lambda e: F.array(
                F.struct(F.lit("human").alias("from"), e["instruction"].alias("value")),
                F.struct(F.lit("gpt").alias("from"), e["output"].alias("value")),
            ),
        )
    )
    return rows.select(*kept, voices.alias("conversations"), F.col("_id").alias("id"))
