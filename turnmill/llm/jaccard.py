"""Similarity join on word shingles by parity sketches.

Every distinct shingle toggles one position of a sketch, so two sketches differ in
at most as many positions as the sets differ in shingles. Cut into more pieces
than a similar pair may differ in shingles, the sketches of such a pair have equal
pieces. The number of pieces follows from a band of set sizes; a set is cut for
its own band and for lower bands that hold similar smaller sets.

There are more pieces than that, by a reserve: similar sets have so many more equal
pieces, and a set does without as many, those that most sets share. What a common
passage puts into the sets is in few pieces of each, and it is these that go.

Equal sets are one class. Classes that share a piece meet one of them only; after
those pairs are verified, what is left to compare are members of a piece that are
not yet connected, and only those whose sketches are near enough come out of that
join. So a group of near copies costs a star, not a square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import each, text_of
from turnmill.llm.components import components
from turnmill.llm.shingles import Shingler, mix64
from turnmill.session import save_step

WORDS = 5
PERCENT = 80
BAND = 1.35  # sizes of a band: from its start to so many times it
RESERVE = 8  # one piece more for so many
LEVEL_BITS = 7  # last bits of a piece's key: its band
SKETCH_BITS = 2048
QUICK_WORDS = 8  # the same sketch folded to 512 positions
FILTER_BITS = 1 << 23  # a fixed megabyte
PART_MEMBERS = 512  # members of a meeting that stay together
MEETING = ["main", "key", "part"]
HELD = 200_000  # numbers that are handed over together

U = np.uint64


@lru_cache(maxsize=None)
def band_starts(most: int) -> tuple[int, ...]:
    """First sizes of the bands up to the one after ``most``."""
    starts = [1]
    while starts[-1] <= most:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND)))
    return tuple(starts)


@lru_cache(maxsize=None)
def band(level: int, percent: int) -> tuple[int, int, int, int]:
    """Largest size, pieces, spare pieces and reserve of a band.

    Sets of sizes s <= l are similar if 100 * common >= percent * union, which
    allows (s + l) * (100 - percent) / (100 + percent) differences, and
    l <= 100 * s / percent.
    """
    starts = [1]
    while len(starts) < level + 2:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND)))
    first, last = starts[level], starts[level + 1] - 1
    differences = (last + 100 * last // percent) * (100 - percent) // (100 + percent)
    # Spare pieces make up for pieces that are empty in both sets.
    reserve = (differences + 1) // RESERVE
    pieces = differences + 1 + reserve
    spare = ceil(1 + 2 * pieces * exp(-first / pieces)) if pieces > 1 else 0
    return last, pieces + spare, spare, reserve


def levels(n: int, percent: int) -> Iterator[tuple[int, int, int]]:
    """Level, pieces and spare pieces of every band that a set of size n is cut for."""
    starts = band_starts(1 << (n.bit_length() + 1))
    level = int(np.searchsorted(starts, n, side="right")) - 1
    while level >= 0:
        last, pieces, spare, _ = band(level, percent)
        if 100 * last < percent * n:
            return
        yield level, pieces, spare
        level -= 1


def set_id(own: np.ndarray) -> int:
    """A 64-bit digest of a set."""
    return int(mix64(np.array([mix64(own).sum() + U(len(own))], np.uint64)).view(np.int64)[0])


def piece_keys(own: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the pieces of a sorted set, for every band it is cut for.

    A key is the exclusive or of a piece's shingles, which is a digest of the
    piece's bits, and ends with the band. Two sets with at most ``pieces - 1 - spare -
    reserve`` differences have more than ``spare + reserve`` equal pieces; a set with no
    more than ``spare`` empty ones need not list those.
    """
    found = []

    def keys(digest: np.ndarray, level: int) -> np.ndarray:
        return mix64(digest) >> U(LEVEL_BITS) << U(LEVEL_BITS) | U(level)

    for level, pieces, spare in levels(len(own), percent):
        piece = ((own >> U(32)) * U(pieces)) >> U(32)
        first = np.concatenate([[0], np.flatnonzero(piece[1:] != piece[:-1]) + 1])
        at = piece[first]
        digest = np.bitwise_xor.reduceat(own, first)
        salt = U(level << 40)
        found.append(keys(digest ^ mix64(at + salt + U(1)), level))
        if pieces - len(at) > spare:
            empty = np.setdiff1d(np.arange(pieces, dtype=np.uint64), at)
            found.append(keys(mix64(empty + salt + U(1)), level))
    return np.concatenate(found).view(np.int64)


def parity_sketch(own: np.ndarray) -> np.ndarray:
    bits = np.bincount((own & U(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _summaries(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in batches:
            sets = shingler.sets(each(batch.column(1)))
            rows = [(len(own), set_id(own) if len(own) else None) for own in sets]
            if rows:
                n, ids = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.int64())],
                    schema=schema,
                )

    return run


def _entries(k: int, percent: int):
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in batches:
            seen, keys, ids, size = set(), [], [], 0
            for own in shingler.sets(each(batch.column(0))):
                if not len(own) or (name := set_id(own)) in seen:
                    continue  # a class enters once per batch
                seen.add(name)
                found = piece_keys(own, percent)
                keys.append(found)
                ids.append(np.full(len(found), name))
                size += len(found)
                if size > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, ids)], schema=schema)
                    keys, ids, size = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, ids)], schema=schema)

    return run


def _sets(k: int, wanted):
    """Sets and sketches of the classes whose place in the fixed-size filter is set."""
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("n", pa.int64()),
            ("sketch", pa.list_(pa.int64())),
            ("quick", pa.list_(pa.int64())),
            ("own", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, words = Shingler(k), wanted.value
        for batch in batches:
            seen, rows, size = set(), [], 0
            for own in shingler.sets(each(batch.column(0))):
                if not len(own):
                    continue
                name = set_id(own)
                slot = name & (FILTER_BITS - 1)
                if name in seen or not (int(words[slot >> 6]) >> (slot & 63)) & 1:
                    continue
                seen.add(name)
                sketch = parity_sketch(own)
                quick = np.bitwise_xor.reduce(sketch.reshape(-1, QUICK_WORDS))
                rows.append((name, len(own), sketch, quick, own.view(np.int64)))
                size += len(own)
                if size > HELD:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                    )
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _filter_words(ids: DataFrame) -> np.ndarray:
    """A bit per value of an id's last bits: at most 131,072 numbers, whatever the data."""
    slot = F.col("id").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (
        ids.select(F.shiftright(slot, 6).alias("w"), F.expr(f"shiftleft(1L, cast(id & 63 as int))").alias("bit"))
        .groupBy("w")
        .agg(F.bit_or("bit").alias("bits"))
    )
    found = words.toPandas()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return table.view(np.uint64)


def _without_reserve(entries: DataFrame, percent: int) -> DataFrame:
    """Entries (key, id, m) but each set's first ones of a band in a common order, as
    many as the reserve of the band: those in most sets.

    Similar sets have more keys of the smaller one's band in common than the reserve.
    Of these, the last in the order is among the first ones of neither set.
    """
    level = F.col("key").bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).cast("int")
    reserves = F.array(*[F.lit(band(i, percent)[3]).cast("long") for i in range(1 << LEVEL_BITS)])
    order = Window.partitionBy("id", "level").orderBy(F.desc("m"), "key")
    placed = entries.withColumn("level", level).withColumn("place", F.row_number().over(order))
    return placed.filter(F.col("place") > F.get(reserves, F.col("level"))).select(*entries.columns)


def _united(members: DataFrame) -> DataFrame:
    """Members (key, main, id, label) of open pieces, each meeting once, and its parts.

    Edited copies share many pieces whose members are almost the same, so a pair would
    meet in each of them. Pieces of one main label are united if all their members
    compared once are fewer pairs than those of the single pieces together. Whoever
    shares a piece still meets.
    """
    out = F.count_if(F.col("label") != F.col("main"))
    single = members.groupBy("main", "key").agg(F.count("*").alias("m"), out.alias("o"))
    single = single.groupBy("main").agg(F.sum(F.col("o").cast("double") * F.col("m")).alias("apart"))
    whole = members.select("main", "id", "label").distinct().groupBy("main")
    whole = whole.agg(F.count("*").alias("m"), out.alias("o"))
    chosen = whole.join(single, "main").filter(F.col("o").cast("double") * F.col("m") < F.col("apart")).select("main")
    united = members.join(chosen.select("main", F.lit(True).alias("united")), "main", "left")
    meeting = F.when(F.col("united"), F.lit(0)).otherwise(F.col("key"))
    placed = save_step(united.select("main", meeting.alias("key"), "id", "label").distinct(), "open_members")
    parts = F.ceil(F.count("*") / PART_MEMBERS).cast("int")
    return placed.join(placed.groupBy("main", "key").agg(parts.alias("parts")), ["main", "key"])


def _distance(left: str, right: str) -> Column:
    """Positions in which two sketches differ."""
    return F.aggregate(
        F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x
    )


def _quick_distance() -> Column:
    """The same for the folded sketches of two rows of members."""
    words = [F.bit_count(F.col(f"x{i}").bitwiseXOR(F.col(f"y{i}"))) for i in range(QUICK_WORDS)]
    return sum(words[1:], words[0])


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The similar pairs (a, b): sketches first, then the sets themselves."""
    short = sets.select("id", "n", "sketch")
    sketched = pairs.join(
        short.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a"
    ).join(short.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b")
    both = F.col("na") + F.col("nb")
    near = sketched.filter(
        (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        & (_distance("ka", "kb") * (100 + percent) <= both * (100 - percent))
    ).select("a", "b", "na", "nb")
    near = save_step(near, "near_pairs")
    whole = near.join(sets.select(F.col("id").alias("a"), F.col("own").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("own").alias("y")), "b"
    )
    common = whole.select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).alias("c"))
    return common.filter(100 * F.col("c") >= percent * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id.

    A text's set holds the distinct shingles of ``words`` words after lowering
    A-Z; fewer words are one shingle. Sets are linked if 100 * common >= percent *
    union; a text without words is linked with nothing. component_id is the
    smallest key connected by links. A row without words is a component of its
    own; a null key is larger than any. Rows that repeat are rows of one class.
    """
    spark = docs.sparkSession
    binary = text_of(text).cast("binary").alias("text")
    narrow = save_step(
        docs.select(F.col(key).cast("bigint").alias("doc_id"), binary).mapInArrow(
            _summaries(words), "doc_id BIGINT, n BIGINT, id BIGINT"
        ),
        "shingle_counts",
    )
    # Shuffled once: the count per piece and the join with it read the same files.
    entries = docs.select(binary).mapInArrow(_entries(words, percent), "key BIGINT, id BIGINT").repartition("key")
    shared = (
        entries.groupBy("key")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("m"))
        .filter("low < high")
        .select("key", "m")
    )
    live = save_step(_without_reserve(entries.join(shared, "key").distinct(), percent), "shared_pieces")
    wanted = spark.sparkContext.broadcast(_filter_words(live.select("id").distinct()))
    sets = save_step(
        docs.select(binary)
        .mapInArrow(_sets(words, wanted), "id BIGINT, n BIGINT, sketch ARRAY<BIGINT>, quick ARRAY<BIGINT>, own ARRAY<BIGINT>")
        .dropDuplicates(["id"]),
        "shingle_sets",
    )
    # The head of a piece is the class that shares most: of a text and its edited
    # copies, the text. A copy that is not similar to it is hardly similar to another.
    shares = live.groupBy("id").agg(F.sum("m").alias("share"))
    heads = (
        live.select("key", "id")
        .join(shares, "id")
        .groupBy("key")
        .agg(F.max(F.struct("share", "id"))["id"].alias("head"))
    )
    stars = live.select("key", "id").join(heads, "key").filter("id <> head")
    stars = save_step(
        stars.select(F.greatest("id", "head").alias("a"), F.least("id", "head").alias("b")).distinct(), "stars"
    )
    links = save_step(_verify(stars, sets, percent), "star_links")

    labels = components(links)
    placed = live.join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    weights = labels.groupBy("label").agg(F.count("*").alias("weight"))
    placed = save_step(
        placed.join(weights, "label", "left").select("key", "id", "label", F.coalesce("weight", F.lit(0)).alias("weight")),
        "placed_pieces",
    )
    # Pieces of three or more classes that are not all connected yet. A passage that
    # some sets share is many pieces with the same members: one of them will do, found
    # by two digests of the members.
    open_pieces = (
        placed.groupBy("key")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.count("*").alias("m"),
            F.max(F.struct("weight", "label")).alias("main"),
            F.bit_xor(F.xxhash64("id")).alias("digest"),
            F.bit_xor(F.xxhash64("id", F.lit(1))).alias("other_digest"),
        )
        .filter("low < high AND m > 2")
        .groupBy("digest", "other_digest", "m")
        .agg(F.min("key").alias("key"), F.first("main.label").alias("main"))
        .select("key", "main")
    )
    quick = sets.select("id", "n", *[F.get("quick", F.lit(i)).alias(f"q{i}") for i in range(QUICK_WORDS)])
    open_rows = save_step(placed.join(open_pieces, "key").select("key", "main", "id", "label"), "open_rows")
    members = _united(open_rows).join(quick, "id")
    words = [f"q{i}" for i in range(QUICK_WORDS)]

    def side(rows: DataFrame, name: str) -> DataFrame:
        own = [F.col(c).alias(f"{name}{i}") for i, c in enumerate(words)]
        return rows.select(
            *MEETING, F.col("id").alias(name), F.col("label").alias(f"l{name}"), F.col("n").alias(f"n{name}"), *own
        )

    # Two sketches differ in no more places than the sets do, so the condition of
    # the join itself turns away what cannot be similar. Two outside meet once.
    # A member is in one part of its meeting; those outside go to all parts.
    outside = members.filter("label <> main").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = members.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    met = side(outside, "x").join(side(dealt, "y"), MEETING).filter(
        (F.col("lx") != F.col("ly"))
        & ((F.col("ly") == F.col("main")) | (F.col("x") < F.col("y")))
        & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
        & (_quick_distance() * (100 + percent) <= (F.col("nx") + F.col("ny")) * (100 - percent))
    )
    pairs = met.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    more = _verify(save_step(pairs.join(stars, ["a", "b"], "left_anti"), "open_pairs"), sets, percent)
    labels = components(links.unionAll(more))

    classes = narrow.filter("id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("first"))
    grouped = classes.join(labels, "id", "left").select("id", "first", F.coalesce("label", "id").alias("label"))
    lowest = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = grouped.join(lowest, "label").select(F.col("id").alias("c"), "component_id")
    return narrow.join(of_class, F.col("id") == F.col("c"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def drop_similar(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row of every component stays, the one with the smallest key; whole rows.

    Rows without words and rows without a key all stay. Rows that share a key stay
    or go together: they go if none of them is the first of its component.
    """
    groups = similar_groups(docs, key, text, words, percent).filter("doc_id IS NOT NULL")
    gone = groups.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("stays"))
    gone = save_step(gone.filter("NOT stays").select(F.col("doc_id").alias("gone")), "similar_rows")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("key_of_row"))
    return rows.join(gone, F.col("key_of_row") == F.col("gone"), "left_anti").select("row.*")
