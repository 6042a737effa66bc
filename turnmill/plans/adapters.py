"""Tables of the test data set as samples, attempts and turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.operators.turns import CLIENTS

CLOSING = " That's all."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn directly followed by an assistant turn is one round.

    Turns are matched on (conversation, turn). All rounds are numbered; the limit
    on rounds is the conversation operator's.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select(
        F.col("conv_id").alias("sample_id"), "turn", F.col("text").alias("prompt")
    )
    answered = turns.filter("role = 'assistant'").select(
        F.col("conv_id").alias("sample_id"),
        (F.col("turn") - 1).alias("turn"),
        F.col("text").alias("response"),
    )
    number = F.row_number().over(Window.partitionBy("sample_id").orderBy("turn"))
    return asked.join(answered, ["sample_id", "turn"]).withColumn("round", number)


def conversation_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounds as attempts that all succeeded at the first try."""
    client = F.element_at(
        F.array(*[F.lit(c) for c in CLIENTS]),
        F.pmod(F.col("sample_id") + F.col("round"), F.lit(3)).cast("int") + 1,
    )
    return conversation_pairs(spark, sf_dir).select(
        "sample_id",
        "round",
        client.alias("client"),
        F.lit(1).alias("attempt_no"),
        "prompt",
        "response",
        F.lit(None).cast("string").alias("error"),
        F.col("turn").cast("double").alias("ts"),
    )


def document_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as attempts: two rounds per sample, three clients, four tries each."""
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.expr("doc_id DIV 24").alias("sample_id"),
        F.expr("doc_id % 24 DIV 12 + 1").alias("round"),
        F.element_at(
            F.array(*[F.lit(c) for c in CLIENTS]), F.expr("doc_id % 12 DIV 4").cast("int") + 1
        ).alias("client"),
        (d % 4 + 1).cast("int").alias("attempt_no"),
        F.concat(F.lit("ask "), F.expr("doc_id DIV 24").cast("string")).alias("prompt"),
        F.col("text").alias("response"),
        F.when(F.col("n_chars") % 3 != 0, F.lit("timeout")).alias("error"),
        d.cast("double").alias("ts"),
    )


def document_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as decided rounds, six per sample; some close the conversation.

    Every document is a round with its whole text. Short and failed rounds stand
    beside them as rows of their own, so a sample has up to twelve rounds.
    """
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents")
    client = F.element_at(F.array(*[F.lit(c) for c in CLIENTS]), (d % 3).cast("int") + 1)

    def rounds(rows: DataFrame, place: int, response: Column, ok: bool) -> DataFrame:
        number = (d % 6 * 2 + place).cast("int")
        return rows.select(
            F.expr("doc_id DIV 6").alias("sample_id"),
            number.alias("round"),
            F.concat(F.lit("ask "), number.cast("string")).alias("prompt"),
            response.alias("response"),
            (client if ok else F.lit(None).cast("string")).alias("client"),
            (d + (place - 1) / 2).cast("double").alias("ts"),
            F.lit(ok).alias("ok"),
        )

    text = F.when(d % 13 == 5, F.concat("text", F.lit(CLOSING))).otherwise(F.col("text"))
    short = d % 7 == 3
    failed = ~short & (F.col("n_chars") % 11 == 0)
    return (
        rounds(docs, 1, text, True)
        .unionAll(rounds(docs.filter(short), 2, F.concat_ws(" / ", F.lit("ok"), "source", "lang"), True))
        .unionAll(rounds(docs.filter(failed), 2, F.lit(None).cast("string"), False))
    )


def round_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rounds as one attempt each."""
    return document_rounds(spark, sf_dir).select(
        "sample_id",
        "round",
        F.coalesce("client", F.lit(CLIENTS[0])).alias("client"),
        F.lit(1).alias("attempt_no"),
        "prompt",
        "response",
        F.when(~F.col("ok"), F.lit("timeout")).alias("error"),
        "ts",
    )


def document_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw JSON samples of eight shapes, by ``doc_id % 8``."""
    shapes = [
        {"question": "lang", "answer": "text"},
        {"instruction": "text", "output": "source"},
        {"prompt": "text", "response": "lang"},
        {"text": "text"},
        {"context": "text", "question": "source"},
        {"context": "text"},
        {"task": "text", "note": "source"},
        {"zeta": "text", "lang": "lang", "alpha": "source", "n": "n_chars"},
    ]
    sample = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        fields = F.struct(*[F.col(c).alias(k) for k, c in shape.items()])
        sample = F.when(F.col("doc_id") % 8 == i, F.to_json(fields)).otherwise(sample)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"), sample.alias("sample")
    )


def spoken_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as raw JSON samples with a ``conversations`` list of all turns.

    An entry is an instruction with its answer as output, a turn without an answer
    (system turns too) as an instruction alone, or an answer to nothing as an output alone.
    """
    turns = table(spark, sf_dir, "conversations")
    whole = Window.partitionBy("conv_id").orderBy("turn")
    asked, answer = F.col("role") == "user", F.col("role") == "assistant"
    paired = F.coalesce(F.lag(asked).over(whole), F.lit(False)) & answer
    following = F.lead(answer).over(whole) & asked
    entries = turns.select(
        F.col("conv_id").alias("sample_id"),
        "turn",
        F.when(~answer, F.col("text")).alias("instruction"),
        F.when(answer, F.col("text")).when(following, F.lead("text").over(whole)).alias("output"),
        paired.alias("_told"),
    ).filter("NOT _told")
    lists = entries.groupBy("sample_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "instruction", "output"))).alias("turns")
    )
    items = F.transform("turns", lambda t: F.struct(t["instruction"].alias("instruction"), t["output"].alias("output")))
    return lists.select(
        F.col("sample_id").alias("pos"),
        F.to_json(F.struct(items.alias("conversations"))).alias("sample"),
    )
