"""The same queries in plain SQL, for an independent engine to check the values."""

from __future__ import annotations

# Fixed values, spelled out here so that a wrong one in the code does not pass.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
VALIDATION_ERROR = "Generated conversation failed validation"
CONTINUATIONS = [
    "请继续详细说明。",
    "能否进一步解释？",
    "还有其他要补充的吗？",
    "Please provide more details.",
    "Could you elaborate further?",
    "Are there any additional points to consider?",
]

STRIP = f"trim({{}}, '{WHITESPACE}')"
PICK = "(('0x' || substr(md5({}), 1, 7))::BIGINT % {})"
CLIENT_LIST = "['claude', 'gemini', 'openai']"


def strip(x: str) -> str:
    return STRIP.format(x)


def valid(x: str) -> str:
    return f"({x} <> '' AND length({strip(x)}) >= 10 AND length({x}) <= 4000)"


def closes(response: str, turn: str) -> str:
    words = ["that''s all", "no more", "finished", "完成", "结束"]
    said = " OR ".join(f"contains(lower({response}), '{w}')" for w in words)
    return f"({said} OR ({turn} >= 3 AND length({strip(response)}) < 20))"


SHUFFLED = (
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r, "
    "count(*) OVER () AS n FROM documents"
)
TRAIN = "CASE WHEN r <= trunc(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split"

STRATIFIED = """
labels_n AS (SELECT lang, count(*) AS c FROM documents GROUP BY lang),
whole AS (SELECT sum(c)::DOUBLE AS n, ceil(sum(c) * 0.2::DOUBLE) AS n_test FROM labels_n),
shares AS (SELECT lang, c / n * (n - n_test) AS s, n - n_test AS n_train FROM labels_n, whole),
quotas AS (
  SELECT lang, floor(s) + CASE WHEN row_number() OVER (ORDER BY s - floor(s) DESC, lang)
    <= n_train - sum(floor(s)) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
stratified AS (
  SELECT doc_id, d.lang, CASE WHEN row_number() OVER (
    PARTITION BY d.lang ORDER BY md5('42:' || doc_id), doc_id) <= quota
    THEN 'train' ELSE 'test' END AS split
  FROM documents d JOIN quotas q ON d.lang = q.lang)
"""

ATTEMPTS = f"""
attempts AS (
  SELECT doc_id // 24 AS sample_id, (doc_id % 24) // 12 + 1 AS round,
    ({CLIENT_LIST})[(doc_id % 12) // 4 + 1] AS client, doc_id % 4 + 1 AS attempt_no,
    'ask ' || (doc_id // 24) AS prompt, text AS response,
    CASE WHEN n_chars % 3 <> 0 THEN 'timeout' END AS error, doc_id::DOUBLE AS ts
  FROM documents)
"""
ROUNDS = f"""
rounds AS (
  SELECT doc_id // 6 AS sample_id, (doc_id % 6 * 2 + 1)::INT AS round,
    'ask ' || (doc_id % 6 * 2 + 1) AS prompt, true AS ok,
    CASE WHEN doc_id % 13 = 5 THEN text || ' That''s all.' ELSE text END AS response,
    ({CLIENT_LIST})[doc_id % 3 + 1] AS client, doc_id::DOUBLE AS ts
  FROM documents
  UNION ALL SELECT doc_id // 6, (doc_id % 6 * 2 + 2)::INT, 'ask ' || (doc_id % 6 * 2 + 2),
    doc_id % 7 = 3, CASE WHEN doc_id % 7 = 3 THEN 'ok / ' || source || ' / ' || lang END,
    CASE WHEN doc_id % 7 = 3 THEN ({CLIENT_LIST})[doc_id % 3 + 1] END, doc_id + 0.5::DOUBLE
  FROM documents WHERE doc_id % 7 = 3 OR n_chars % 11 = 0)
"""
JUDGED = f"""
judged AS (SELECT *, ok AND {valid('response')} AS good FROM rounds WHERE round <= 10),
counted AS (
  SELECT *, count(*) FILTER (WHERE good) OVER (PARTITION BY sample_id ORDER BY round) AS turn_no
  FROM judged),
ended AS (
  SELECT *, NOT ok OR (good AND {closes('response', 'turn_no')}) AS ends FROM counted),
history AS (
  SELECT sample_id, round, prompt, response, client, ts FROM ended e
  WHERE good AND NOT EXISTS (SELECT 1 FROM ended f
    WHERE f.sample_id = e.sample_id AND f.round < e.round AND f.ends))
"""
HISTORY = f"{ROUNDS}, {JUDGED}"
RESULTS = f"""{HISTORY},
samples AS (SELECT DISTINCT doc_id // 6 AS sample_id FROM documents),
spans AS (SELECT sample_id, max(ts) - min(ts) AS span FROM rounds GROUP BY sample_id),
results AS (
  SELECT s.sample_id, count(h.round) > 0 AS success,
    CASE WHEN count(h.round) = 0 THEN '{VALIDATION_ERROR}' END AS error_message,
    CASE WHEN count(h.round) = 0 THEN 0.0 ELSE any_value(span) END::DOUBLE AS processing_time,
    CASE WHEN count(h.round) = 0 THEN '' ELSE arg_max(h.client, h.round) END AS api_client_used,
    count(h.round) AS num_turns
  FROM samples s JOIN spans USING (sample_id) LEFT JOIN history h USING (sample_id)
  GROUP BY s.sample_id),
halves AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || sample_id), sample_id)
    <= trunc(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
  FROM results)
"""
PAIRS = """
next_turns AS (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (
  SELECT conv_id AS sample_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS round,
    text AS prompt, next_text AS response, turn
  FROM next_turns WHERE role = 'user' AND next_role = 'assistant')
"""
SPOKEN_HISTORY = f"""{PAIRS}, rounds AS (
  SELECT sample_id, round, prompt, response, true AS ok, '' AS client, turn::DOUBLE AS ts
  FROM pairs), {JUDGED},
places AS (
  SELECT sample_id, row_number() OVER (ORDER BY md5('42:' || sample_id), sample_id) AS r,
    trunc(count(*) OVER () * 0.8::DOUBLE) AS n_train, count(*) OVER () AS n
  FROM (SELECT DISTINCT sample_id FROM pairs))
"""
RANKED = """
winners AS (
  SELECT sample_id, round, response, client, ts FROM (
    SELECT a.*, row_number() OVER (PARTITION BY sample_id, round ORDER BY {order}) AS place
    FROM attempts a WHERE error IS NULL AND attempt_no <= 3) WHERE place = 1),
every AS (SELECT DISTINCT sample_id, round, prompt FROM attempts)
"""
PLACE = "CASE client WHEN 'claude' THEN 1 WHEN 'gemini' THEN 2 ELSE 3 END"
MIXED_TEXT = """CASE doc_id % 8
  WHEN 0 THEN lang || ' ' || text WHEN 1 THEN text || ' ' || source
  WHEN 2 THEN text || ' ' || lang
  ELSE concat_ws(' ', CASE WHEN length(text) > 10 THEN text END,
    CASE WHEN doc_id % 8 IN (4, 6, 7) AND length(source) > 10 THEN source END) END"""
# Every turn of a conversation, alone or as a pair of question and answer.
ENTRIES = """
placed AS (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text, lag(role) OVER w AS last_role
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
entries AS (
  SELECT conv_id AS sample_id, turn, CASE WHEN role <> 'assistant' THEN text END AS instruction,
    CASE WHEN role = 'assistant' THEN text WHEN role = 'user' AND next_role = 'assistant'
      THEN next_text END AS output
  FROM placed WHERE role <> 'assistant' OR last_role IS DISTINCT FROM 'user')
"""
SPOKEN_TEXT = "string_agg(concat_ws(' ', instruction, output), ' ' ORDER BY turn)"
VALID_MIXED = (
    f"CASE WHEN doc_id % 8 = 1 THEN {strip('text')} <> '' AND {strip('source')} <> '' "
    f"ELSE length({strip('(' + MIXED_TEXT + ')')}) >= 10 END"
)
VALID_SPOKEN = (
    f"bool_and(coalesce({strip('instruction')}, '') <> '' AND coalesce({strip('output')}, '') <> '')"
)
# One field each, in document order, as the JSON writer prints them.
SHAPES = """CASE doc_id % 8
  WHEN 0 THEN '{"question":' || to_json(lang) || ',"answer":' || to_json(text) || '}'
  WHEN 1 THEN '{"instruction":' || to_json(text) || ',"output":' || to_json(source) || '}'
  WHEN 2 THEN '{"prompt":' || to_json(text) || ',"response":' || to_json(lang) || '}'
  WHEN 3 THEN '{"text":' || to_json(text) || '}'
  WHEN 4 THEN '{"context":' || to_json(text) || ',"question":' || to_json(source) || '}'
  WHEN 5 THEN '{"context":' || to_json(text) || '}'
  WHEN 6 THEN '{"task":' || to_json(text) || ',"note":' || to_json(source) || '}'
  ELSE '{"zeta":' || to_json(text) || ',"lang":' || to_json(lang) || ',"alpha":'
    || to_json(source) || ',"n":' || n_chars || '}' END"""
CJK = "(length(text) - length(regexp_replace(text, '[\\x{4e00}-\\x{9fff}]', '', 'g')))"
TOKENS = f"trunc({CJK} / 1.5::DOUBLE + (length(text) - {CJK}) / 4.0::DOUBLE)::BIGINT"
CLEAN = f"trim(regexp_replace(text, '[{WHITESPACE}]+', ' ', 'g'))"
LINES = "[" + ", ".join("'" + x + "'" for x in CONTINUATIONS) + "]"

ORACLE: dict[str, str] = {
    "jsonl_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "json_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "json_document": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "load_many": "SELECT doc_id AS id, text, 'documents' AS source FROM documents "
    "UNION ALL SELECT item_id, text, 'benchmark' FROM benchmark",
    "merge_union_all": "SELECT doc_id AS id, text FROM documents "
    "UNION ALL SELECT item_id, text FROM benchmark",
    "split_shuffle": f"SELECT doc_id, {TRAIN} FROM ({SHUFFLED})",
    "split_ordered": "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= "
    "trunc(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM documents",
    "split_stratified": f"WITH {STRATIFIED} SELECT doc_id, lang, split FROM stratified",
    "stratified_labels": f"""WITH labelled AS (
        SELECT d.doc_id, quality, coalesce(quality::VARCHAR, 'unknown') AS lang
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
      {STRATIFIED.replace("documents", "labelled")}
      SELECT s.doc_id, quality, split FROM stratified s JOIN labelled l ON s.doc_id = l.doc_id""",
    "test_subsample": f"SELECT doc_id, {TRAIN} FROM ({SHUFFLED}) WHERE r <= "
    "trunc(n * 0.8::DOUBLE) + least(n - trunc(n * 0.8::DOUBLE), trunc(n * 0.8::DOUBLE) // 10)",
    "split_stats": f"WITH {STRATIFIED} SELECT count(*) AS total_samples, "
    "count(*) FILTER (WHERE split = 'train') AS train_samples, "
    "count(*) FILTER (WHERE split = 'test') AS test_samples, "
    "count(*) FILTER (WHERE split = 'train') / count(*)::DOUBLE AS train_ratio, "
    "count(*) FILTER (WHERE split = 'test') / count(*)::DOUBLE AS test_ratio FROM stratified",
    "split_field_stats": f"""WITH s AS (
      SELECT unnest(json_keys(({SHAPES})::JSON)) AS field,
        row_number() OVER (ORDER BY doc_id) <= trunc(count(*) OVER () * 0.8::DOUBLE) AS train
      FROM documents)
      SELECT field, CASE WHEN bool_or(train) AND bool_or(NOT train) THEN 'common'
        WHEN bool_or(train) THEN 'train_only' ELSE 'test_only' END AS presence
      FROM s GROUP BY field""",
    "prompt_from_sample": """SELECT doc_id, CASE doc_id % 8
      WHEN 0 THEN '问题：' || lang || chr(10) || '请提供详细的回答。'
      WHEN 1 THEN '指令：' || text || chr(10) || '请按照指令执行并提供详细的回答。'
      WHEN 2 THEN text
      WHEN 3 THEN '请基于以下内容进行扩展和详细说明：' || chr(10) || text
      WHEN 4 THEN '基于以下背景信息：' || text || chr(10) || '问题：' || source || chr(10)
        || '请提供详细的回答。'
      WHEN 5 THEN '基于以下背景信息进行分析和说明：' || chr(10) || text
      WHEN 6 THEN '请对以下内容进行详细分析和说明：' || chr(10) || text
      ELSE '请基于以下信息进行分析和详细说明：' || chr(10) || '{' || chr(10)
        || '  "zeta": ' || to_json(text) || ',' || chr(10) || '  "lang": ' || to_json(lang)
        || ',' || chr(10) || '  "alpha": ' || to_json(source) || ',' || chr(10)
        || '  "n": ' || n_chars || chr(10) || '}' END AS prompt FROM documents""",
    "next_prompt": f"""SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN
      ({LINES})[{PICK.format("'42:' || (doc_id // 8) || ':' || (doc_id % 8 + 1)", 6)} + 1]
      ELSE '' END AS prompt FROM documents""",
    "valid_response": f"SELECT doc_id, {valid('text')} AS valid FROM documents",
    "end_of_conversation": f"WITH {ROUNDS} SELECT sample_id, round, "
    f"{closes('response', 'round')} AS closes FROM rounds WHERE ok",
    "assemble_history": f"WITH {HISTORY} SELECT * FROM history",
    "arriving_conversations": f"WITH {HISTORY} SELECT * FROM history",
    "valid_conversation": f"""WITH {HISTORY}
      SELECT s.sample_id, coalesce(bool_and(length({strip('response')}) >= 10
        AND length(response) <= 4000), false) AS valid
      FROM (SELECT DISTINCT sample_id FROM rounds) s LEFT JOIN history h
        ON s.sample_id = h.sample_id GROUP BY s.sample_id""",
    "first_success": f"""WITH {ATTEMPTS}, {RANKED.format(order=PLACE + ', attempt_no')}
      SELECT e.sample_id, e.round, response, client, ts, client IS NOT NULL AS ok
      FROM every e LEFT JOIN winners w ON e.sample_id = w.sample_id AND e.round = w.round""",
    "preferred_client": f"""WITH {ATTEMPTS}, a AS (
      SELECT sample_id, round, bool_or(error IS NULL AND client = 'claude') AS c,
        bool_or(error IS NULL AND client = 'gemini') AS g,
        bool_or(error IS NULL AND client = 'openai') AS o FROM attempts GROUP BY ALL)
      SELECT sample_id, round,
        CASE WHEN c THEN 'claude' WHEN g THEN 'gemini' WHEN o THEN 'openai' END AS by_default,
        CASE WHEN o THEN 'openai' WHEN g THEN 'gemini' WHEN c THEN 'claude' END AS by_wish
      FROM a""",
    "random_client": f"""WITH {ATTEMPTS}, picked AS (
        SELECT *, ({CLIENT_LIST})[{PICK.format("'42:' || sample_id || ':' || round", 3)} + 1]
          AS chosen FROM attempts),
      winners AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY sample_id, round ORDER BY
          CASE WHEN client = chosen THEN 0 ELSE {PLACE} END, attempt_no) AS place
        FROM picked WHERE error IS NULL AND attempt_no <= 3) WHERE place = 1)
      SELECT e.sample_id, e.round, e.chosen, w.client, w.ts
      FROM (SELECT DISTINCT sample_id, round, chosen FROM picked) e
      LEFT JOIN winners w ON e.sample_id = w.sample_id AND e.round = w.round""",
    "client_stats": f"""WITH {ATTEMPTS}
      SELECT c.client, count(a.ts) AS request_count,
        coalesce(max(a.ts), 0.0)::DOUBLE AS last_request_time, true AS available
      FROM (SELECT unnest({CLIENT_LIST}) AS client) c LEFT JOIN attempts a
        ON a.client = c.client GROUP BY c.client""",
    "batch_responses": f"""WITH {ATTEMPTS}, {RANKED.format(order=PLACE + ', attempt_no')}
      SELECT e.sample_id, e.round, e.prompt, coalesce(response, '') AS response,
        coalesce(client, 'failed') AS client
      FROM every e LEFT JOIN winners w ON e.sample_id = w.sample_id AND e.round = w.round""",
    "batch_conversations": f"WITH {RESULTS} SELECT sample_id, num_turns FROM results",
    "result_rows": f"WITH {RESULTS} SELECT * FROM results",
    "batch_numbers": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 16 + 1 AS batch "
    "FROM documents",
    "extract_text": f"WITH {ENTRIES} SELECT doc_id AS pos, {MIXED_TEXT} AS text FROM documents "
    f"UNION ALL SELECT sample_id, {SPOKEN_TEXT} FROM entries GROUP BY sample_id",
    "valid_sample": f"WITH {ENTRIES} SELECT doc_id AS pos, {VALID_MIXED} AS valid FROM documents "
    f"UNION ALL SELECT sample_id, {VALID_SPOKEN} FROM entries GROUP BY sample_id",
    "validate_filter": f"""WITH {ENTRIES}
      SELECT doc_id AS pos, md5({SHAPES}) AS hash FROM documents WHERE {VALID_MIXED}
      UNION ALL SELECT sample_id, md5('{{"conversations":[' || string_agg(
        '{{"instruction":' || to_json(instruction) || ',"output":' || to_json(output) || '}}',
        ',' ORDER BY turn) || ']}}') FROM entries GROUP BY sample_id HAVING {VALID_SPOKEN}""",
    "content_hash": "SELECT doc_id, md5(text) AS hash FROM documents",
    "dedup_exact": "SELECT doc_id, text, lang, source, n_chars FROM documents QUALIFY "
    "row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1",
    "dedup_near_equal": f"SELECT doc_id FROM documents QUALIFY text = '' OR row_number() OVER "
    f"(PARTITION BY lower({strip('text')}) ORDER BY doc_id) = 1",
    "dedup_candidates": f"""
      WITH docs AS (SELECT doc_id, lower({strip("coalesce(text, '')")}) AS t FROM documents),
      texts AS (SELECT t, min(doc_id) AS k FROM docs GROUP BY t),
      letters AS (SELECT k, unnest(regexp_extract_all(t, '(?s).')) AS c FROM texts),
      counts AS (SELECT k, c, count(*) AS n FROM letters GROUP BY ALL),
      sizes AS (SELECT k, sum(n)::BIGINT AS size FROM counts GROUP BY k),
      near AS (SELECT x.k AS a, y.k AS b, x.size AS n_a, y.size AS n_b FROM sizes x JOIN sizes y ON y.k < x.k
        WHERE 2.0::DOUBLE * least(x.size, y.size) / (x.size + y.size) >= 0.85::DOUBLE),
      pairs AS (SELECT a, b, n_a, n_b, sum(least(x.n, y.n))::BIGINT AS common
        FROM near JOIN counts x ON x.k = a JOIN counts y ON y.k = b AND y.c = x.c
        GROUP BY ALL HAVING 2.0::DOUBLE * common / (n_a + n_b) >= 0.85::DOUBLE)
      SELECT a, b, n_a, n_b, common FROM pairs""",
    "sft_records": f"""WITH {RESULTS}
      SELECT sample_id, processing_time, api_client_used, num_turns, prompt AS instruction,
        response AS output, '' AS input, round::BIGINT AS round, client AS api_client,
        ts AS timestamp FROM results JOIN history USING (sample_id) WHERE success""",
    "to_alpaca": f"""WITH {RESULTS}
      SELECT sample_id, arg_min(prompt, round) AS instruction, '' AS input,
        arg_min(response, round) AS output FROM history GROUP BY sample_id
      UNION ALL SELECT doc_id, text, '', source FROM documents WHERE doc_id % 8 = 1""",
    "to_sharegpt": f"""WITH {RESULTS}, numbered AS (SELECT *,
        row_number() OVER (PARTITION BY sample_id ORDER BY round) - 1 AS turn_no FROM history)
      SELECT sample_id, '' AS id, 2 * turn_no AS place, 'human' AS speaker, prompt AS value
      FROM numbered
      UNION ALL SELECT sample_id, '', 2 * turn_no + 1, 'gpt', response FROM numbered""",
    "to_chatglm": f"""WITH {RESULTS}
      SELECT sample_id, arg_min(prompt, round) AS prompt, arg_min(response, round) AS response,
        0::BIGINT AS n_history FROM history GROUP BY sample_id""",
    "flagship_records": f"""WITH {SPOKEN_HISTORY}
      SELECT sample_id, arg_min(prompt, round) AS instruction, '' AS input,
        arg_min(response, round) AS output,
        CASE WHEN any_value(r <= n_train) THEN 'train' ELSE 'test' END AS split
      FROM history JOIN places USING (sample_id)
      WHERE r <= n_train + least(n - n_train, n_train // 10) GROUP BY sample_id""",
    "preview_text": "SELECT doc_id, CASE WHEN length(text) <= 200 THEN text "
    "ELSE substr(text, 1, 197) || '...' END AS preview FROM documents",
    "token_estimate": f"SELECT doc_id, {TOKENS} AS tokens FROM documents",
    "token_budget": f"SELECT source, lang, count(*) AS samples, sum({TOKENS})::BIGINT AS tokens "
    "FROM documents GROUP BY source, lang",
    "clean_text": f"SELECT doc_id, {CLEAN} AS cleaned FROM documents",
    "clean_savings": f"SELECT source, sum(length(text) - length({CLEAN}))::BIGINT "
    "AS characters_saved FROM documents GROUP BY source",
    "generation_metadata": f"""WITH {RESULTS}
      SELECT count(*) FILTER (WHERE split = 'train') AS total_train_samples,
        count(*) FILTER (WHERE split = 'train' AND success) AS successful_train_samples,
        count(*) FILTER (WHERE split = 'test') AS total_test_samples,
        count(*) FILTER (WHERE split = 'test' AND success) AS successful_test_samples
      FROM halves""",
    "progress_stats": f"""WITH {RESULTS}
      SELECT count(*) AS processed_samples, count(*) FILTER (WHERE NOT success) AS failed_samples,
        count(*) AS total_results, count(*) FILTER (WHERE success) AS successful_results
      FROM results""",
    "run_summary": f"""WITH {RESULTS}
      SELECT count(*) FILTER (WHERE split = 'train') AS total_train_samples,
        count(*) FILTER (WHERE split = 'train' AND success) AS successful_train_samples,
        count(*) FILTER (WHERE split = 'test') AS total_test_samples,
        count(*) FILTER (WHERE split = 'test' AND success) AS successful_test_samples,
        'out/train' AS train_path, (SELECT count(*) FROM rounds) AS requests
      FROM halves""",
    "dedup_incremental": "SELECT doc_id, doc_id % 3 AS run FROM documents QUALIFY "
    "row_number() OVER (PARTITION BY text ORDER BY doc_id % 3, doc_id) = 1",
    "resume_pending": f"WITH {RESULTS} SELECT sample_id FROM results WHERE NOT success",
}
