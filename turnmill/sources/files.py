"""Loaders: every file becomes rows of ``pos`` and one JSON text ``sample``."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from turnmill.functions.text import strip
from turnmill.operators.positions import with_positions
from turnmill.session import save_step
from turnmill.sources.blocks import csv_records, json_records, pieces

# Suffixes and names of the formats.
SUFFIXES = {".jsonl": "jsonl", ".json": "json", ".csv": "csv"}
JSON_ALIASES = ("json", "gala", "browsecomp")
# Cells that count as missing (the public pandas default list).
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# How an array written with two-space indent opens and separates objects.
INDENTED_OPEN = "[\n  {"
INDENTED_BETWEEN = "\n  },\n  {"
HEAD_PIECES = (1_000, 100_000)  # pieces between commas that show how a file is laid out
DATA_LIST = r'\A\ufeff?\s*\{?\s*"data"\s*:\s*\['  # where the list of a wrapper begins


# Where a row comes from; positions follow it.
F_FILE, F_BLOCK = ORIGIN = ("_file", "_block")


def _with_origin(df: DataFrame) -> DataFrame:
    """Rows of a file source with their file and the start of their block in it."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(F_FILE),
        F.col("_metadata.file_block_start").alias(F_BLOCK),
    )


def one_json_value(value: Column) -> Column:
    """Whether a text is one JSON value and nothing after it.

    The parser stops after the first value, so the text is tried inside a list and
    inside an object: what follows a value breaks one of them.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    field = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit(',"end":1}')))
    return listed.isNotNull() & field.isNotNull()


def _checked(value: Column, what: str) -> Column:
    bad = F.raise_error(F.concat(F.lit(f"{what}: "), F.substring(value, 1, 200)))
    return F.when(~one_json_value(value), bad.cast("string")).otherwise(value)


def checked_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Text lines as JSON samples: blank lines are skipped, a bad line is an error."""
    kept = lines.filter(strip(F.col("value")) != "")
    value = _checked(F.col("value"), "bad JSON line") if strict else F.col("value")
    others = [c for c in lines.columns if c != "value"]
    return kept.select(value.alias("sample"), *others)


def _jsonl_rows(spark: SparkSession, path: str, strict: bool) -> DataFrame:
    return checked_lines(_with_origin(spark.read.text(path)), strict)


def read_jsonl(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """One JSON value per line; blank lines are skipped, a bad line is an error."""
    return with_positions([_jsonl_rows(spark, path, strict)])


def _indented_rows(spark: SparkSession, path: str) -> DataFrame:
    """Objects of an indented array, read in parallel.

    Raw line breaks cannot occur inside JSON strings and deeper levels are
    indented further, so the separator only stands between top-level objects
    and the file can be cut there.
    """
    pieces = _with_origin(spark.read.option("lineSep", INDENTED_BETWEEN).text(path))
    body = F.col("value")
    body = F.when(
        F.startswith(body, F.lit(INDENTED_OPEN)), F.substring(body, len(INDENTED_OPEN) + 1, 1 << 30)
    ).otherwise(body)
    body = F.regexp_replace(body, r"\n  \}\n\]\s*\z", "")
    whole = F.concat(F.lit("{"), body, F.lit("\n}"))
    return pieces.select(_checked(whole, "bad JSON object").alias("sample"), *ORIGIN)


def _head(spark: SparkSession, path: str, count: int) -> tuple[list[str], bool]:
    """The first lines of a file, as far as its first commas show them, and whether that is all."""
    found = pieces(spark, path, ",").limit(count).collect()
    text = b",".join(bytes(r["value"]) for r in found).decode("utf-8", "replace")
    return text.removeprefix("\ufeff").split("\n"), len(found) < count


def _json_rows(spark: SparkSession, path: str, unwrap: bool = True) -> DataFrame:
    # Only the head of the file is looked at here, to choose how to read it.
    for count in HEAD_PIECES:
        lines, whole = _head(spark, path, count)
        if whole or len(lines) > 1 or lines[0].lstrip()[:1] != "{":
            break
    if [x.rstrip() for x in lines[:2]] == ["[", "  {"]:
        return _indented_rows(spark, path)
    cut = [] if whole else lines[-1:]
    lines = [x for x in lines if x.strip()][:2]
    if len(lines) == 2 and _is_object(lines[0]) and (_is_object(lines[1]) or (lines[1:] == cut and lines[1].lstrip()[0] == "{")):
        return _jsonl_rows(spark, path, strict=True)  # what this package writes as JSON
    return _document_rows(spark, path, unwrap)


def _is_object(line: str) -> bool:
    try:
        return isinstance(json.loads(line), dict)
    except ValueError:
        return False


def _document_rows(spark: SparkSession, path: str, unwrap: bool) -> DataFrame:
    """The rows of JSON documents, one a file, cut by many tasks."""
    parts = save_step(json_records(spark, path), "json_parts")
    value = F.col("value")
    # Of every file: how it opens, its last part, and the members of its object.
    opens = strip(F.regexp_replace(F.min_by("value", "_row"), "\\A\ufeff", ""))
    named = value.rlike(DATA_LIST) & (F.col("level") == 1)
    files = parts.groupBy(F_FILE).agg(
        F.substring(opens, 1, 1).alias("kind"), F.max("_row").alias("end"), F.max(F.when(named, F.col("_row"))).alias("data")
    )
    if not unwrap:
        files = files.withColumn("data", F.lit(None).cast("bigint"))
    files = files.withColumn("data", F.when(F.col("kind") == "{", F.col("data")))
    members = parts.filter("level = 1").select(F_FILE, F.col("_row").alias("start"))
    after = (
        files.filter("data IS NOT NULL").join(members, F_FILE).filter("start > data")
        .groupBy(F.col(F_FILE).alias("f")).agg((F.min("start") - 1).alias("stop"))
    )
    files = save_step(files.join(after, F.col(F_FILE) == F.col("f"), "left").drop("f"), "json_files")
    files = files.withColumn("stop", F.coalesce("stop", "end"))
    placed = parts.join(files, F_FILE)

    row = F.col("_row")
    listed = placed.filter("kind = '['").select(F_FILE, row, *_trimmed(row == 0, row == F.col("end"), r"\A\ufeff?\s*\[", r"\]\s*\z"))
    inside = placed.filter("data IS NOT NULL AND _row BETWEEN data AND stop")
    closing = F.when(F.col("stop") == F.col("end"), F.lit(r"\]\s*\}\s*\z")).otherwise(F.lit(r"\]\s*\z"))
    wrapped = inside.select(
        F_FILE, (row - F.col("data")).alias("_row"), *_trimmed(row == F.col("data"), row == F.col("stop"), DATA_LIST, closing)
    )
    elements = listed.unionAll(wrapped).filter("NOT (only AND trim(value) = '')")
    checked = _checked(F.when(F.col("sound"), F.col("value")).otherwise(F.lit("")), "bad JSON file")
    rows = elements.select(F.from_json(F.concat(F.lit("["), checked, F.lit("]")), "array<string>")[0].alias("sample"), F_FILE, "_row")

    # Objects themselves; the list of one that is unwrapped stands empty in it.
    left = placed.filter("kind = '{' AND (data IS NULL OR NOT _row BETWEEN data AND stop)")
    empty = F.when(F.col("stop") == F.col("end"), F.lit('"data":[]}')).otherwise(F.lit('"data":[]'))
    opened = F.when(F.col("data") == 0, F.lit("{")).otherwise(F.lit(""))
    hole = files.filter("data IS NOT NULL").select(F_FILE, F.col("data").alias("_row"), F.concat(opened, empty).alias("value"))
    texts = left.select(F_FILE, "_row", "value").unionAll(hole).groupBy(F_FILE).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_row", "value"))), lambda p: p["value"]), ",").alias("v")
    )
    known = _checked(strip(F.regexp_replace("v", "\\A\ufeff", "")), "bad JSON file")
    objects = texts.select(known.alias("v"), F_FILE).withColumn("wrapper", F.array_contains(F.json_object_keys("v"), "data"))
    if unwrap:
        objects = objects.filter("NOT wrapper")
    # A check must be computed even for objects of which no row comes.
    objects = objects.filter("v IS NOT NULL").select(F.col("v").alias("sample"), F_FILE, F.lit(0).cast("bigint").alias("_row"))
    return save_step(rows.unionAll(objects), "json_rows")


def _trimmed(first: Column, last: Column, opening: str, closing: str | Column) -> list[Column]:
    """A part without the brackets of its list; whether they stood where they must; if it is the only one."""
    closing = F.lit(closing) if isinstance(closing, str) else closing
    value = F.when(first, F.regexp_replace("value", opening, "")).otherwise(F.col("value"))
    text = F.when(last, F.regexp_replace(value, closing, F.lit(""))).otherwise(value)
    sound = (~first | F.col("value").rlike(opening)) & (~last | F.regexp_like("value", closing))
    return [text.alias("value"), sound.alias("sound"), (first & last).alias("only")]


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A list gives its elements, an object its ``data`` list or itself as one row.

    A file or folder whose first two lines are whole objects is JSON Lines. A list, alone
    or as ``data``, is read by many tasks however it is laid out; an array written with
    two-space indent in one pass, any other in two.
    """
    return with_positions([_json_rows(spark, path)])


#: What a cell must be for a column to have a type, from the narrowest on; any cell is a string.
CSV_TYPES = ("bigint", "double")


def _csv_cells(spark: SparkSession, path: str, multi_line: bool) -> tuple[DataFrame, list[str], list[str]]:
    """All cells as strings, missing ones NULL, the names of the columns, and where a row comes from."""
    options = {"escape": '"', "quote": '"'}
    if not multi_line:
        raw = spark.read.csv(path, header=True, **options)
        return _with_origin(raw), raw.columns, list(ORIGIN)
    # Names as Spark makes them, from the first record alone.
    names = spark.read.csv(path, header=True, multiLine=True, **options).columns
    records = csv_records(spark, path).filter("_row > 0")
    line = F.regexp_replace("value", r"\r\z", "")
    fields = ", ".join(f"c{i} STRING" for i in range(len(names)))  # names may hold anything
    row = F.from_csv(line, fields, {**options, "multiLine": "true"})
    own = [F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(names)]
    rows = records.select(row.alias("row"), F_FILE, (F.col("_row") - 1).alias("_row"))
    return rows.select(*own, F_FILE, "_row"), names, [F_FILE, "_row"]


def _csv_typed(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Typed columns. The cells are read once, and written while their types are found."""
    raw, names, origin = _csv_cells(spark, path, multi_line)
    cells = raw.select(*[F.when(~F.col(f"`{c}`").isin(MISSING_CELLS), F.col(f"`{c}`")).alias(c) for c in names], *origin)
    misses = []
    for i, c in enumerate(names):
        col = F.col(f"`{c}`")
        misses += [F.count_if(col.isNotNull() & col.try_cast(k).isNull()).alias(f"{i}_{k}") for k in CSV_TYPES]
        misses.append(F.count_if(~col.isin("True", "False", "TRUE", "FALSE")).alias(f"{i}_b"))
        misses.append(F.count(col).alias(f"{i}_n"))
    if multi_line:
        # Only whether a count is zero matters, so a task that is run again does no harm.
        seen = Observation()
        cells = save_step(cells.observe(seen, *misses) if misses else cells, "cells")
        found = seen.get if misses else {}
    else:
        found = cells.agg(*misses).first()
    typed = []
    for i, c in enumerate(names):
        if not found[f"{i}_n"]:
            kind = "double"
        elif not found[f"{i}_b"]:
            kind = "boolean"
        else:
            kind = next((k for k in CSV_TYPES if not found[f"{i}_{k}"]), "string")
        typed.append(F.col(f"`{c}`").cast(kind).alias(c))
    return cells.select(*typed, *origin)


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A typed table with header names; the usual missing-value words become NULL.

    With ``multi_line`` a cell in quotes may hold line breaks. A scan finds out where
    records begin, so that many tasks read a file; without it one scan is saved.
    """
    return with_positions([_csv_typed(spark, path, multi_line)])


def to_samples(df: DataFrame, out: str = "sample") -> DataFrame:
    """A typed table as ``pos`` and JSON samples holding every column, NULLs included."""
    kept = [c for c in df.columns if c in ("pos", "_row", *ORIGIN)]
    fields = [F.col(f"`{c}`") for c in df.columns if c not in kept]
    return df.select(*kept, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(out))


def detect_format(spark: SparkSession, path: str) -> str:
    """Format by suffix, else by the first line; unreadable paths count as JSON."""
    lowered = path.lower()
    for suffix, name in SUFFIXES.items():
        if lowered.endswith(suffix):
            return name
    try:
        head = spark.read.text(path).select(strip(F.col("value")).alias("v")).first()
    except Exception:  # the documented fallback for anything unreadable
        return "json"
    line = head["v"] if head else ""
    if line.startswith("{") and line.endswith("}"):
        return "jsonl"
    return "json" if line[:1] in ("[", "{") else "csv"


def _rows(spark: SparkSession, path: str, fmt: str, multi_line: bool = True) -> DataFrame:
    if fmt == "auto":
        fmt = detect_format(spark, path)
    if fmt == "jsonl":
        return _jsonl_rows(spark, path, strict=True)
    if fmt in JSON_ALIASES:
        return _json_rows(spark, path)
    if fmt == "csv":
        return to_samples(_csv_typed(spark, path, multi_line))
    raise ValueError(f"unsupported format: {fmt}")


def load(spark: SparkSession, path: str, fmt: str = "auto", multi_line: bool = True) -> DataFrame:
    """Load one data set as ``pos``, ``sample``; ``multi_line`` as in :func:`read_csv`."""
    return with_positions([_rows(spark, path, fmt, multi_line)])


def load_many(
    spark: SparkSession, paths: list[str], formats: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """Load several data sets in order and tag every sample with ``_source``.

    The tag is a column and also a key of the JSON sample, replacing one that
    is there already. Lists of different lengths are an error.
    """
    formats = formats or ["auto"] * len(paths)
    if len(formats) != len(paths):
        raise ValueError("give one format per path")
    frames = []
    for path, fmt in zip(paths, formats):
        rows = _rows(spark, path, fmt, multi_line)
        tagged = _with_key(F.col("sample"), "_source", path)
        origin = [c for c in ("_row", *ORIGIN) if c in rows.columns]
        frames.append(rows.select(tagged.alias("sample"), F.lit(path).alias("_source"), *origin))
    return with_positions(frames)


def _with_key(sample: Column, key: str, value: str) -> Column:
    """The JSON object with one string key set, other keys as they are and in order."""
    keys = F.json_object_keys(sample)
    entry = json.dumps({key: value}, ensure_ascii=False)[1:]
    fields = F.from_json(F.when(F.array_contains(keys, key), sample), "map<string,variant>")
    others = F.map_filter(fields, lambda k, _: k != key)
    # A sample that has the key already is written again without it.
    base = F.when(fields.isNotNull(), F.to_json(others)).otherwise(sample)
    count = F.coalesce(F.size(others), F.size(keys))
    comma = F.when(count > 0, F.lit(", ")).otherwise(F.lit(""))
    return F.concat(F.regexp_replace(base, r"\}\s*\z", ""), comma, F.lit(entry))


def merge(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All samples of several JSON or JSON Lines files, untagged, in path order.

    A ``data`` wrapper is left as it is: such a file gives one row.
    """
    frames = []
    for path in paths:
        if path.endswith(".jsonl"):
            frames.append(_jsonl_rows(spark, path, strict=True))
        else:
            frames.append(_json_rows(spark, path, unwrap=False))
    return with_positions(frames)
