"""Quality by nearest-neighbour voting in a latent-semantic space.

A bounded sample of labelled rows gives the terms' weights, the leading singular
directions of its weighted term counts, and the labelled vectors in them. These
have a fixed size and are sent to all tasks; there every document's vector meets
every labelled vector, block by block, in exact products. The nearest labelled
rows vote with a weight that grows with their cosine.

A term is a run of three UTF-8 bytes, hashed, or a word that repeats the word
before it (one term for all of them).
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnmill.llm.common import slices, text_of
from turnmill.session import save_step

SAMPLE_ROWS = 4_096  # labelled documents that a model learns from, at most
TERMS = 4_096  # hashed terms; the first is the repeated word
REPEAT_WEIGHT = 2.0  # of that first term, against the others
DIMENSIONS = 32
NEIGHBOURS = 16  # that vote; with those as near as the last
SHARPNESS = 8  # power of the cosine that a vote weighs
DOCUMENTS = 256  # whose vectors are computed together
SEED = 5


def term_counts(data: bytes) -> np.ndarray:
    """Counts of all terms of a whole text."""
    counts, last = np.zeros(TERMS, np.int64), b""
    for start, end in slices(data):
        part = np.frombuffer(data, np.uint8)[max(0, start - 2) : end].astype(np.uint32)
        if len(part) >= 3:
            runs = part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)
            mixed = (runs * np.uint32(2654435761)) >> np.uint32(16)
            counts += np.bincount(mixed % np.uint32(TERMS - 1) + 1, minlength=TERMS)
        words = data[start:end].split()
        counts[0] += sum(map(operator.eq, words, words[1:])) + (words[:1] == [last])
        last = words[-1] if words else last
    return counts


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(length > 0, length, 1)).astype(np.float32)


@dataclass
class Model:
    """Term weights, directions, and the labelled vectors with their labels.

    At most ``TERMS * (DIMENSIONS + 1)`` and ``SAMPLE_ROWS * (DIMENSIONS + 1)`` numbers.
    """

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def embed(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors of rows of counts; zero for a row without terms."""
        return _unit(_unit(np.log1p(counts) * self.weights) @ self.directions)

    def votes(self, vectors: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among each vector's neighbours.

        Rows as near as the last neighbour vote too, so equal vectors never compete.
        A vector without a neighbour of positive cosine gets the share of all rows;
        without any labelled row the score is 0.5.
        """
        if not len(self.labels):
            return np.full(len(vectors), 0.5)
        cosine = np.round(vectors @ self.vectors.T, 6)
        place = max(0, cosine.shape[1] - NEIGHBOURS)
        least = np.partition(cosine, place, axis=1)[:, place, None]
        weight = np.where(cosine >= least, np.maximum(cosine, 0), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        share = weight @ self.labels / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, share, self.labels.mean()), 0, 1)


def train(counts: np.ndarray, labels: np.ndarray) -> Model:
    """A model of rows of counts; labels are 0 to 1.

    The directions are found by power iterations from fixed random ones, so the
    same rows in the same order give the same model.
    """
    rows = len(labels)
    weights = np.log((1 + rows) / (1 + (counts > 0).sum(axis=0))) + 1
    weights[0] *= REPEAT_WEIGHT
    weighted = _unit(np.log1p(counts) * weights)
    start = np.random.default_rng(SEED).standard_normal((TERMS, 2 * DIMENSIONS)).astype(np.float32)
    basis = np.linalg.qr(weighted @ start)[0]
    for _ in range(4):
        basis = np.linalg.qr(weighted @ (weighted.T @ basis))[0]
    directions = np.linalg.svd(basis.T @ weighted, full_matrices=False)[2][:DIMENSIONS].T
    model = Model(weights, np.ascontiguousarray(directions), np.empty((0, 0)), labels)
    model.vectors = model.embed(counts)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from at most ``rows`` labelled documents, the first by a hash of their key.

    ``training`` is a condition on the key. A key with several labels has their mean;
    of several rows of one key one is taken. Null keys and labels teach nothing, a null
    text is an empty one. Spark limits keys and rows before it moves them; whole texts
    become counts where they lie, and only the sample's counts reach the driver.
    """
    known = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label"))
        .filter(F.col("key").isNotNull() & F.col("label").isNotNull())
        .groupBy("key")
        .agg(F.avg("label").alias("label"))
    )
    texts = docs.filter(training).select(F.col(key).alias("key"), text_of(text).alias("text"))
    turn = F.xxhash64("key")
    chosen = known.join(texts.select("key"), "key", "left_semi").orderBy(turn, "key").limit(rows)
    chosen = save_step(chosen, "labelled_sample")  # at most ``rows`` keys
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("text"), "text"))
    sample = texts.join(F.broadcast(chosen), "key").withColumn("first", first).filter("first = 1")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [term_counts(t.as_py().encode()) for t in batch.column(2)]
            terms = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([t.astype("<u2").tobytes() for t in terms], pa.binary()),
                    pa.array([c[t].astype("<u4").tobytes() for c, t in zip(found, terms)], pa.binary()),
                ],
                names=["turn", "label", "terms", "counts"],
            )

    schema = "turn BIGINT, label DOUBLE, terms BINARY, counts BINARY"
    found = sample.select(turn.alias("turn"), "label", "text").mapInArrow(count, schema).collect()
    counts = np.zeros((len(found), TERMS), np.float32)
    found = sorted(found, key=lambda r: (r["turn"], r["label"], bytes(r["terms"]), bytes(r["counts"])))
    for i, row in enumerate(found):
        counts[i, np.frombuffer(row["terms"], "<u2")] = np.frombuffer(row["counts"], "<u4")
    return train(counts, np.array([r["label"] for r in found], np.float64).clip(0, 1))


def score(docs: DataFrame, model: Model, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` with ``score``, the weighted share of label 1 among a text's neighbours.

    Null and empty texts, and texts under three bytes, have the share of all labelled rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, text_of(text).alias("_text_to_score"))
    names = rows.columns[:-1]
    schema = StructType(rows.schema.fields[:-1]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        counts = np.zeros((DOCUMENTS, TERMS), np.float32)
        for batch in batches:
            texts, scores = batch.column(len(names)), []
            for start in range(0, len(texts), DOCUMENTS):
                group = texts.slice(start, DOCUMENTS)
                for i, value in enumerate(group):
                    counts[i] = term_counts(value.as_py().encode())
                scores.append(learned.votes(learned.embed(counts[: len(group)])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate([[], *scores]), pa.float64())],
                names=[*names, "score"],
            )

    return rows.mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows that teach nothing: crc32 of the key as text leaves 0 of 5. A null key is not one."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
