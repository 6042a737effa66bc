"""Order MinHash fingerprints, in DataFrame functions only.

Every run of ``WORDS`` tokens is numbered by how often it occurred before, hashed,
and ordered in ``ORDERS`` ways. Each order selects its ``PICKED`` least runs; these
go back into text order and are hashed as a tuple. Two texts agree in a tuple when
they share its runs in the same order, so moved passages count as edits.

Order j compares hash XOR j (in the leading bits). The least by order j are
therefore the least of bucket j, or of the nearest bucket with runs if j has too
few, so one sort of a text's hashes serves all orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import tasks, text_of

TOKEN = r"[^\x20\x09-\x0D]{1,12}"  # long words are cut, so unspaced scripts have tokens too
WORDS = 3
ORDER_BITS = 5
ORDERS = 1 << ORDER_BITS
PICKED = 2
HASH_BITS = 36
PLACE_BITS = 63 - HASH_BITS  # places up to 134 million

CUTS = 64  # at most so many times so many ranges of keys


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pack(value: Column, place: Column) -> Column:
    """The first ``HASH_BITS`` bits of a hash before a place, as a sortable number."""
    return F.shiftleft(F.shiftrightunsigned(value, 64 - HASH_BITS), PLACE_BITS).bitwiseOR(place)


def _earlier(runs: Column, value: Column, i: Column) -> Column:
    """How many entries before ``i`` have the hash of ``value``, in a sorted array.

    Equal hashes are neighbours, so the number is found bit by bit.
    """
    code = F.shiftright(value, PLACE_BITS)

    def same(back: Column) -> Column:
        return (i >= back) & F.coalesce(F.shiftright(F.get(runs, i - back), PLACE_BITS) == code, F.lit(False))

    steps = F.array(*[F.lit(1 << b) for b in range(PLACE_BITS - 1, -1, -1)])
    search = F.aggregate(steps, F.lit(0), lambda n, step: F.when(same(n + step), n + step).otherwise(n))
    return F.when(same(F.lit(1)), search).otherwise(F.lit(0))


def fingerprint(text: Column) -> Column:
    """The ``ORDERS`` tuple hashes of a text, as integers. A text of fewer than
    ``WORDS`` tokens is one run; a text without tokens is one empty run."""
    place_mask = (1 << PLACE_BITS) - 1

    def runs_of(tokens: Column) -> Column:
        last = F.greatest(F.size(tokens) - WORDS, F.lit(0))
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: _pack(F.xxhash64(*[F.get(tokens, i + w) for w in range(WORDS)]), i.cast("bigint")),
        )

    def numbered(runs: Column) -> Column:
        return F.transform(
            runs,
            lambda x, i: _pack(
                F.xxhash64(F.shiftright(x, PLACE_BITS), _earlier(runs, x, i)), x.bitwiseAND(F.lit(place_mask))
            ),
        )

    def bucket(x: Column) -> Column:
        return F.shiftright(x, 63 - ORDER_BITS).cast("int")

    def firsts(ordered: Column) -> Column:
        """The least ``PICKED`` of every bucket: no order selects any other."""
        return F.filter(
            ordered,
            lambda x, i: (i < PICKED) | (bucket(F.get(ordered, F.greatest(i - PICKED, F.lit(0)))) != bucket(x)),
        )

    def by_bucket(least: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(ORDERS - 1)), lambda b: F.filter(least, lambda x: bucket(x) == b)
        )

    def tuples(buckets: Column) -> Column:
        near = F.sequence(F.lit(0), F.lit(ORDERS - 1))

        def picked(j: Column) -> Column:
            own = F.get(buckets, j)
            all_near = F.flatten(F.transform(near, lambda k: F.get(buckets, j.bitwiseXOR(k))))
            return F.when(F.size(own) >= PICKED, F.slice(own, 1, PICKED)).otherwise(F.slice(all_near, 1, PICKED))

        def in_text_order(chosen: Column) -> Column:
            turned = F.transform(
                chosen,
                lambda x: F.shiftleft(x.bitwiseAND(F.lit(place_mask)), HASH_BITS).bitwiseOR(
                    F.shiftright(x, PLACE_BITS)
                ),
            )
            hashes = F.transform(F.sort_array(turned), lambda x: x.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
            return F.xxhash64(hashes).bitwiseAND(F.lit(0xFFFFFFFF))

        return F.transform(near, lambda j: in_text_order(picked(j)))

    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return _let(
        _let(F.sort_array(_let(tokens, runs_of)), lambda runs: F.sort_array(numbered(runs))),
        lambda ordered: _let(_let(firsts(ordered), by_bucket), tuples),
    )


def as_text(tuples: str) -> Column:
    """A fingerprint as a string: eight hexadecimal digits per order."""
    return F.array_join(F.transform(tuples, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(left: str, right: str) -> Column:
    """Share of equal tuples, 0 to 1."""
    equal = F.zip_with(left, right, lambda x, y: F.when(x == y, 1).otherwise(0))
    return F.aggregate(equal, F.lit(0), lambda n, x: n + x) / F.lit(float(ORDERS))


def key_ranges(docs: DataFrame, key: str) -> tuple[Column, list, int]:
    """The range of a row's key as a column, the ranges' first keys, and their number.

    Cut points are approximate quantiles, at most ``CUTS`` squared whatever the
    data; they are found in two steps of at most ``CUTS`` comparisons. Range 0
    holds the rows without key and the least keys.
    """
    wanted = min(CUTS * CUTS, 4 * tasks(docs.sparkSession))
    shares = [i / wanted for i in range(1, wanted)] or [0.5]
    found = docs.select(F.percentile_approx(key, F.array(*[F.lit(s) for s in shares]), F.lit(20 * wanted)).alias("c"))
    cuts = sorted(set(found.first()["c"] or []))
    if not cuts:
        return F.lit(0), [], 1
    groups = [cuts[i : i + CUTS] for i in range(0, len(cuts), CUTS)]
    heads = F.array(*[F.lit(g[0]).cast("bigint") for g in groups])
    parts = F.array(*[F.array(*[F.lit(c).cast("bigint") for c in g]) for g in groups])

    def range_of(k: Column) -> Column:
        group = F.size(F.filter(heads, lambda h: h <= k)) - 1
        inside = _let(group, lambda g: g * CUTS + F.size(F.filter(F.get(parts, g), lambda c: c <= k)))
        return F.when(group < 0, F.lit(0)).otherwise(inside)

    return F.coalesce(range_of(F.col(key)), F.lit(0)), cuts, len(cuts) + 1


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (part, doc_id, text, borrowed, turn) in which the next row by key follows.

    Rows lie in ranges of keys. The first row of a range is there twice: as
    ``borrowed`` it ends the range before, and that of the first range ends the
    last. Keys are bigint; a null key is less than any, equal keys go by text.
    """
    part, _, _ = key_ranges(docs, key)
    rows = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text"), part.cast("int").alias("part"))
    rows = rows.withColumn("turn", F.xxhash64("text"))
    # One row per range, whatever the data.
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "turn")).alias("f")
    found = rows.groupBy("part").agg(first).select("part", "f.doc_id", "f.turn").collect()
    firsts = sorted((tuple(r) for r in found), key=lambda r: r[0])
    if not firsts:
        return rows.withColumn("borrowed", F.lit(False))
    spark = docs.sparkSession
    order = [p for p, _, _ in firsts]
    table = spark.createDataFrame(
        [(p, d, t, order[i - 1]) for i, (p, d, t) in enumerate(firsts)], "p INT, d BIGINT, t BIGINT, lender INT"
    )
    placed = rows.join(
        F.broadcast(table),
        (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("turn") == F.col("t")),
        "left",
    )
    here = F.struct(F.col("part").alias("part"), F.lit(False).alias("borrowed"))
    there = F.struct(F.col("lender").alias("part"), F.lit(True).alias("borrowed"))
    places = F.when(F.col("p").isNull(), F.array(here)).otherwise(F.array(here, there))
    return placed.select("doc_id", "text", "turn", F.explode(places).alias("at")).select(
        "at.part", "doc_id", "text", "at.borrowed", "turn"
    )


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text ends with the beginning of the next text instead of its own
    last quarter. A null text is empty; empty texts are like each other. Equal
    keys follow each other in a fixed order; a single row is its own successor.
    """
    rows = with_next(docs, key, text)
    order = Window.partitionBy("part").orderBy("borrowed", F.col("doc_id").asc_nulls_first(), "turn")
    n = F.length("text").cast("bigint")
    cut = F.col("n_chars") - F.expr("n_chars div 4")
    edited = F.concat(
        F.substring("text", F.lit(1), cut.cast("int")),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), F.expr("cast(n_chars div 4 as int)")),
    )
    texts = rows.select("*", F.lead("text").over(order).alias("next_text"), n.alias("n_chars"))
    own = texts.select(
        "part",
        "doc_id",
        "borrowed",
        "turn",
        "n_chars",
        F.sha2(edited, 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("own"),
        F.when(~F.col("borrowed"), fingerprint(edited)).alias("changed"),
    )
    pairs = own.select("*", F.lead("own").over(order).alias("following")).filter("NOT borrowed")
    return pairs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("own").alias("fingerprint"),
        as_text("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
    )
