"""Prompts, text and validity of raw JSON samples.

A sample is the JSON text of one object in column ``sample``. Whether a key is
*present* decides everything, and a key holding null is present, so samples are
parsed once into an order-keeping ``map<string, variant>``: its keys give
presence and order, its values give type and content.
"""

from __future__ import annotations

import json
import string
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from turnmill.functions.text import hash_pick, strip

# Prompt templates with the keys each one needs, first match wins.
PROMPT_TEMPLATES = [
    (("question", "answer"), "问题：{question}\n请提供详细的回答。"),
    (("instruction",), "指令：{instruction}\n请按照指令执行并提供详细的回答。"),
    (("prompt",), "{prompt}"),
    (("text",), "请基于以下内容进行扩展和详细说明：\n{text}"),
    (("context", "question"), "基于以下背景信息：{context}\n问题：{question}\n请提供详细的回答。"),
    (("context",), "基于以下背景信息进行分析和说明：\n{context}"),
    (("content",), "请对以下内容进行详细分析和说明：\n{content}"),
    (("input",), "请对以下内容进行详细分析和说明：\n{input}"),
    (("description",), "请对以下内容进行详细分析和说明：\n{description}"),
    (("task",), "请对以下内容进行详细分析和说明：\n{task}"),
    (("query",), "请对以下内容进行详细分析和说明：\n{query}"),
]
WHOLE_SAMPLE_PREFIX = "请基于以下信息进行分析和详细说明：\n"

# The lines that continue a conversation.
CONTINUATIONS = [
    "请继续详细说明。",
    "能否进一步解释？",
    "还有其他要补充的吗？",
    "Please provide more details.",
    "Could you elaborate further?",
    "Are there any additional points to consider?",
]

# Key pairs that hold a sample's text, and the fallback's limits.
TEXT_PAIRS = [("instruction", "output"), ("question", "answer"), ("prompt", "response")]
LONG_VALUE = 10
MIN_TEXT = 10

# Kinds of JSON value whose Python text needs no Python.
PRINTED = ("VOID", "BOOLEAN", "STRING", "BIGINT")


def _python_text(value: str | None) -> str | None:
    return None if value is None else str(json.loads(value))


def _indented_text(value: str | None) -> str | None:
    return None if value is None else json.dumps(json.loads(value), ensure_ascii=False, indent=2)


@F.pandas_udf(StructType([StructField(c, StringType()) for c in ("first", "second", "whole")]))
def _printed(first: pd.Series, second: pd.Series, whole: pd.Series) -> pd.DataFrame:
    """Two JSON values as Python prints them and an object with two-space indent.

    What does not need Python arrives as NULL, which is most of it.
    """
    return pd.DataFrame(
        {
            "first": first.map(_python_text),
            "second": second.map(_python_text),
            "whole": whole.map(_indented_text),
        }
    )


@F.pandas_udf(StringType())
def _indented(values: pd.Series) -> pd.Series:
    """The object as JSON with two-space indent; rows not needing it arrive as NULL."""
    return values.map(_indented_text)


def parse(sample: Column) -> Column:
    """The sample as map<string, variant> in document order; NULL if not an object."""
    return F.from_json(sample, "map<string,variant>")


def has(parsed: Column, *keys: str) -> Column:
    """True when every key is present, whatever it holds."""
    each = [F.coalesce(F.map_contains_key(parsed, k), F.lit(False)) for k in keys]
    return reduce(lambda a, b: a & b, each)


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _as_string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _with_fields(
    work: DataFrame, sample: str, first: Column, second: Column, whole: Column
) -> DataFrame:
    """Add ``_first`` and ``_second``, the values of two keys as Python formats them, and ``_whole``.

    The keys are chosen per row (NULL for none), so one further parse, which keeps
    nested key order, and one Python call serve every template: None, True, 12 and
    abc are printed natively, lists, objects and fractions go to Python.
    """
    parsed = F.col("_parsed")
    work = work.withColumns({"_k1": first, "_k2": second})
    work = work.withColumns({"_v1": parsed[F.col("_k1")], "_v2": parsed[F.col("_k2")]})
    work = work.withColumns({"_t1": _kind(F.col("_v1")), "_t2": _kind(F.col("_v2"))})
    odd = {i: F.coalesce(~F.col(f"_t{i}").isin(*PRINTED), F.lit(False)) for i in (1, 2)}
    work = work.withColumns({"_o1": odd[1], "_o2": odd[2], "_w": whole})
    needs = F.col("_o1") | F.col("_o2")
    work = work.withColumn("_raws", F.from_json(F.when(needs, F.col(sample)), "map<string,string>"))
    raw = {i: F.when(F.col(f"_o{i}"), F.col("_raws")[F.col(f"_k{i}")]) for i in (1, 2)}
    work = work.withColumn("_py", _printed(raw[1], raw[2], F.when(F.col("_w"), F.col(sample))))

    def text(i: int, printed: str) -> Column:
        value, kind = F.col(f"_v{i}"), F.col(f"_t{i}")
        return (
            F.when(kind == "VOID", F.lit("None"))
            .when(kind == "BOOLEAN", F.initcap(_as_string(value)))
            .when(F.col(f"_o{i}"), F.col(f"_py.{printed}"))
            .otherwise(_as_string(value))
        )

    made = [f"_{c}{i}" for c in "kvto" for i in (1, 2)] + ["_w", "_raws", "_py"]
    return work.withColumns(
        {"_first": text(1, "first"), "_second": text(2, "second"), "_whole": F.col("_py.whole")}
    ).drop(*made)


def _chosen(choice: Column, values: list[str | None]) -> Column:
    """The entry of ``values`` at the row's choice; NULL where there is none."""
    listed = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(listed, choice)


def _fill(template: str, lookup: Callable[[str], Column]) -> Column:
    parts: list[Column] = []
    for literal, key, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if key:
            parts.append(lookup(key))
    return F.concat(*parts)


def _template_keys(template: str) -> list[str]:
    return [key for _, key, _, _ in string.Formatter().parse(template) if key]


def with_prompt(df: DataFrame, sample: str = "sample", out: str = "prompt") -> DataFrame:
    """Derive the prompt of each raw sample."""
    work = df.withColumn("_parsed", parse(F.col(sample)))
    parsed = F.col("_parsed")
    choice = F.lit(len(PROMPT_TEMPLATES))
    for i, (keys, _) in reversed(list(enumerate(PROMPT_TEMPLATES))):
        choice = F.when(has(parsed, *keys), F.lit(i)).otherwise(choice)
    work = work.withColumn("_choice", choice)
    # No template has more than two places: the row's own two keys are looked up.
    used = [_template_keys(t) for _, t in PROMPT_TEMPLATES]
    names = [{k: f"_{place}" for k, place in zip(keys, ("first", "second"))} for keys in used]
    keyed = [_chosen(F.col("_choice"), [(k + [None, None])[i] for k in used]) for i in (0, 1)]
    work = _with_fields(work, sample, *keyed, F.col("_choice") == len(PROMPT_TEMPLATES))
    text = F.concat(F.lit(WHOLE_SAMPLE_PREFIX), F.col("_whole"))
    for i, (_, template) in reversed(list(enumerate(PROMPT_TEMPLATES))):
        filled = _fill(template, lambda k, i=i: F.col(names[i][k]))
        text = F.when(F.col("_choice") == i, filled).otherwise(text)
    return work.withColumn(out, text).drop("_parsed", "_choice", "_first", "_second", "_whole")


def prompt_column(columns: list[str]) -> Column:
    """Prompt for a typed table: the columns settle the template when planning."""
    for keys, template in PROMPT_TEMPLATES:
        if all(k in columns for k in keys):
            return _fill(
                template, lambda k: F.coalesce(F.col(k).cast("string"), F.lit("None"))
            )
    everything = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.concat(F.lit(WHOLE_SAMPLE_PREFIX), _indented(everything))


def next_prompt(seed: int, sample_id: Column, round_no: Column, history: Column) -> Column:
    """The continuation line for a round; '' when there is no history yet."""
    lines = F.array(*[F.lit(x) for x in CONTINUATIONS])
    at = hash_pick(len(CONTINUATIONS), seed, sample_id, round_no).cast("int") + 1
    return F.when(history > 0, F.element_at(lines, at)).otherwise(F.lit(""))


def _conversation_items(parsed: Column) -> Column:
    return F.try_variant_get(parsed["conversations"], "$", "array<variant>")


def sft_text(conversations: Column) -> Column:
    """Text of a typed record: every instruction and output, joined by a blank."""
    both = F.transform(conversations, lambda c: F.array(c["instruction"], c["output"]))
    return F.array_join(F.flatten(both), " ")


def _with_text(work: DataFrame, sample: str, out: str) -> DataFrame:
    """The text of samples that are parsed already in ``_parsed``."""
    parsed = F.col("_parsed")
    choice = F.lit(None).cast("int")
    for i, pair in reversed(list(enumerate(TEXT_PAIRS))):
        choice = F.when(has(parsed, *pair), F.lit(i)).otherwise(choice)
    choice = F.when(~has(parsed, "conversations"), choice)
    work = work.withColumn("_choice", choice)
    keyed = [_chosen(F.col("_choice"), [pair[i] for pair in TEXT_PAIRS]) for i in (0, 1)]
    work = _with_fields(work, sample, *keyed, F.lit(False))
    spoken = F.transform(
        _conversation_items(parsed),
        lambda c: F.array(
            F.try_variant_get(c, "$.instruction", "string"),
            F.try_variant_get(c, "$.output", "string"),
        ),
    )
    long_strings = F.filter(
        F.map_values(parsed),
        lambda v: (_kind(v) == "STRING") & (F.length(_as_string(v)) > LONG_VALUE),
    )
    text = (
        F.when(has(parsed, "conversations"), F.array_join(F.flatten(spoken), " "))
        .when(F.col("_choice").isNotNull(), F.concat("_first", F.lit(" "), "_second"))
        .otherwise(F.array_join(F.transform(long_strings, _as_string), " "))
    )
    return work.withColumn(out, F.coalesce(text, F.lit(""))).drop(
        "_choice", "_first", "_second", "_whole"
    )


def with_text(df: DataFrame, sample: str = "sample", out: str = "text") -> DataFrame:
    """Add the text of each raw sample."""
    work = df.withColumn("_parsed", parse(F.col(sample)))
    return _with_text(work, sample, out).drop("_parsed")


def with_validity(df: DataFrame, sample: str = "sample", out: str = "valid") -> DataFrame:
    """Add whether each raw sample is usable."""
    work = df.withColumn("_parsed", parse(F.col(sample)))
    work = _with_text(work, sample, "_text")
    parsed = F.col("_parsed")
    items = _conversation_items(parsed)

    def spoken(value: Column) -> Column:
        return F.coalesce(strip(value) != "", F.lit(False))

    good_turns = F.coalesce(
        (F.size(items) > 0)
        & F.forall(
            items,
            lambda c: spoken(F.try_variant_get(c, "$.instruction", "string"))
            & spoken(F.try_variant_get(c, "$.output", "string")),
        ),
        F.lit(False),
    )
    good_pair = spoken(_as_string(parsed["instruction"])) & spoken(_as_string(parsed["output"]))
    valid = (
        F.when(parsed.isNull(), F.lit(False))
        .when(has(parsed, "conversations"), good_turns)
        .when(has(parsed, "instruction", "output"), good_pair)
        .otherwise(F.length(strip(F.col("_text"))) >= MIN_TEXT)
    )
    return work.withColumn(out, valid).drop("_parsed", "_text")
