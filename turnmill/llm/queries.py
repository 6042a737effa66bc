"""One query per operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm import (
    collocations,
    exact,
    fingerprints,
    hard_negatives,
    jaccard,
    language,
    line_dedup,
    mixing,
    packing,
    quality_votes,
    substring_dedup,
    token_counts,
    warc,
)
from turnmill.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words every document gives to the mix of sources; null texts give none."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("words"))
    plan = mixing.mix_plan(docs, size=F.col("words"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated runs of lines: of three lines, of 50 words, or whole."""
    rows = line_dedup.drop_repeated_lines(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "removed_lines", F.sha2("text", 256).alias("text_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from rows that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language.held_out()
    model = language.fit(docs, ~held_out)
    return language.predict(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages that every document repeats from another or from itself."""
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted from flat token files."""
    docs = read(spark, sf_dir, "documents")
    return token_counts.document_token_counts(docs).select("doc_id", "n_tokens")


def op7_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document; the digest stands for the ids."""
    pieces = packing.pack(read(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    records = warc.archive(read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles are similar at 0.85."""
    return jaccard.similar_groups(read(spark, sf_dir, "documents"), words=4, percent=85)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    return exact.exact_groups(read(spark, sf_dir, "documents"))


def op11_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, by votes of labelled ones that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = quality_votes.held_out()
    model = quality_votes.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    scored = quality_votes.score(docs, model, [F.col("doc_id"), held_out.alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language of all documents."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


QUERIES: dict[str, Query] = {
    "op1_source_mix": op1_source_mix,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_order_minhash": op5_order_minhash,
    "op6_token_counts": op6_token_counts,
    "op7_power_of_two_packing": op7_power_of_two_packing,
    "op8_warc_roundtrip": op8_warc_roundtrip,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_neighbour_quality": op11_neighbour_quality,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"
NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"
BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

ORACLE: dict[str, str] = {
    "op1_source_mix": f"""
      WITH docs AS (
        SELECT doc_id, source, {WORDS}::BIGINT AS size,
          md5('17:' || coalesce(doc_id::VARCHAR, '-')) AS turn FROM documents),
      by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
      placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM by_source),
      weighed AS (SELECT *, (place - 1) % 3 + 1 AS weight FROM placed),
      limits AS (SELECT *, (3 * source_size)::DOUBLE / weight AS most FROM weighed),
      levels AS (SELECT *,
          (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
        FROM limits
        WINDOW before AS (ORDER BY most, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      water AS (SELECT arg_min(level, (most, place)) AS w FROM levels WHERE most >= level),
      goals AS (SELECT source, place, source_size,
          CASE WHEN most >= level THEN w * weight ELSE (3 * source_size)::DOUBLE END AS target
        FROM levels, water),
      streams AS (SELECT d.*, g.place, g.source_size, g.target,
          sum(size) OVER (PARTITION BY g.place ORDER BY turn, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ends
        FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
      copies AS (SELECT *, (ends + copy * source_size)::DOUBLE / target AS time
        FROM streams, (SELECT unnest([0, 1, 2]) AS copy) WHERE size > 0),
      queue AS (SELECT *, sum(size) OVER (ORDER BY least(floor(time * 4096), 8192), time, place, copy, turn
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM copies),
      taken AS (SELECT place, ends, count(*) AS n FROM queue
        WHERE used <= (SELECT sum(size) FROM docs) GROUP BY place, ends)
      SELECT doc_id, size, s.source_size, target,
        (CASE WHEN size > 0 THEN coalesce(n, 0) * size ELSE 0 END)::BIGINT AS taken
      FROM streams s LEFT JOIN taken t ON s.place = t.place AND s.ends = t.ends AND size > 0""",
    "op2_line_dedup": r"""
      WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
          unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
      solid AS (SELECT doc_id, i, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line
        FROM lines WHERE trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
      counted AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
          count(*) OVER (PARTITION BY doc_id) AS lines FROM solid),
      next AS (SELECT *, lead(line) OVER w AS line2, lead(line, 2) OVER w AS line3, lead(n) OVER w AS n2,
          lead(i) OVER w AS i2, lead(i, 2) OVER w AS i3
        FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
      runs AS (
        SELECT doc_id, i, 1 AS size, line AS run, [i] AS covered, n >= 50 OR lines = 1 AS counts FROM next
        UNION ALL
        SELECT doc_id, i, 2, line || chr(10) || line2, [i, i2], n + n2 >= 50 OR lines = 2
        FROM next WHERE line2 IS NOT NULL
        UNION ALL
        SELECT doc_id, i, 3, line || chr(10) || line2 || chr(10) || line3, [i, i2, i3], true
        FROM next WHERE line3 IS NOT NULL),
      placed AS (SELECT *, row_number() OVER (PARTITION BY size, run ORDER BY doc_id, i) AS place FROM runs),
      later AS (SELECT * FROM placed WHERE place > 1 AND counts),
      gone AS (SELECT DISTINCT doc_id, unnest(covered) AS i FROM later)
      SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS removed_lines,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '')) AS text_sha256
      FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
      UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL""",
    "op9_ngram_jaccard": r"""
      WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x20\x09-\x0D]+') AS w FROM documents),
      places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0),
      sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM places),
      sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
      common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b
        ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
      links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
        WHERE 100 * c >= 85 * (p.n + q.n - c)),
      ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
      reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
        UNION SELECT r.x, b.y FROM reach r JOIN ways b ON r.y = b.x)
      SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id
      FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
      GROUP BY d.doc_id""",
    "op10_exact_dedup": f"""
      WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, {NORM} AS norm FROM documents),
      g AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS r,
        first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY norm) AS group_size FROM d)
      SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op12_phrase_collocations": r"""
      WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
      words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
      places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
      phrases AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a
        FROM places, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
      totals AS (SELECT lang, sum(a)::BIGINT AS n FROM phrases WHERE m = 1 GROUP BY lang),
      candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE m > 1 AND a >= 30),
      starts AS (SELECT *, unnest(range(1, m)) AS i FROM candidates WHERE m > 2),
      longer AS (SELECT lang, array_to_string(w[i:i + o - 1], ' ') AS phrase, max(a) AS longest
        FROM starts, (SELECT unnest([2, 3]) AS o) WHERE o < m AND i + o - 1 <= m GROUP BY ALL),
      cuts AS (SELECT c.*, unnest(range(1, m)) AS k FROM candidates c LEFT JOIN longer USING (lang, phrase)
        WHERE longest IS NULL OR 100 * longest < 80 * a),
      scored AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r,
          ((2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a))::BIGINT AS score
        FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
          JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
        QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1)
      SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
        phrase, a, l, r, n, score
      FROM scored JOIN totals USING (lang) QUALIFY rank <= 2000""",
    "op13_hard_negatives": """
      WITH vectors AS (SELECT vec_id,
          CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
          [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
      scores AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
          coalesce(list_sum([coalesce(p[1] * p[2], 0) FOR p IN list_zip(a.v, b.v)]), 0)::BIGINT AS score
        FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
      near AS (SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
        FROM scores WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
      SELECT anchor_id, positive_id,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
      FROM near JOIN scores USING (anchor_id)
      WHERE label <> near.anchor_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
      QUALIFY rank <= 3""",
}

_FIVE = "('0x' || substr(hex, {0}, 5))::BIGINT"
_DIGEST = " || ".join(
    f"substr({BASE32}, ({_FIVE.format(5 * i + 1)} >> {shift}) % 32 + 1, 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)
ORACLE["op8_warc_roundtrip"] = f"""
  WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
      coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
  f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
  SELECT page_id, payload_bytes, {_DIGEST} AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""
