"""The queries' counterparts in DuckDB SQL, written independently: windows where the Spark
side aggregates and joins, brute-force scoring where it streams."""

from __future__ import annotations

from workload.queries import BASELINE_BEFORE, RUN_ID, SIMILAR_FROM

_WS = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORD = r"[\p{L}\p{N}_]+"
_NOW = "TIMESTAMP '2026-03-01 03:00:00'"
_EVENTS_NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {_strip(c)} = '')"


def _parsed(c: str) -> str:
    shapes = [
        (r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"),
        (r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y"),
        (r"\d{1,2}/\d{1,2}/\d{2}", "%d/%m/%y"),
        (r"\d{4}/\d{1,2}/\d{1,2}", "%Y/%m/%d"),
    ]
    cases = " ".join(
        f"WHEN regexp_full_match({c}, '{shape}') THEN CAST(try_strptime({c}, '{fmt}') AS DATE)"
        for shape, fmt in shapes
    )
    return f"CASE {cases} END"


_KB = r"""kb AS (
  SELECT d.doc_id AS ingest_seq,
         substr(sha256(split_part(d.text, chr(10), 1)), 1, 12) AS doc_id,
         CASE d.lang WHEN 'de' THEN 'postgres' WHEN 'es' THEN 'jira' ELSE 'file' END AS source_type,
         CASE d.lang WHEN 'de' THEN 'postgres' WHEN 'es' THEN 'jira' ELSE 'file' END
           || '/' || CAST(d.doc_id AS VARCHAR) AS source_uri,
         split_part(d.text, chr(10), 1) AS title,
         CASE WHEN d.doc_id % 50 = 9 THEN NULL
              WHEN d.doc_id % 50 = 19 THEN '2026-13-45'
              WHEN d.doc_id % 10 = 6 THEN strftime(dt, '%d/%m/%Y')
              WHEN d.doc_id % 10 = 7 THEN strftime(dt, '%d/%m/%y')
              WHEN d.doc_id % 10 = 8 THEN strftime(dt, '%Y/%m/%d')
              ELSE strftime(dt, '%Y-%m-%d') END AS effective_date,
         CASE WHEN d.doc_id % 4 = 3 THEN NULL
              ELSE 'v' || CAST(d.doc_id % 4 + 1 AS VARCHAR) END AS version,
         CASE l.quality WHEN 0 THEN 0.55::DOUBLE WHEN 1 THEN 0.95::DOUBLE
              ELSE 1.0::DOUBLE END AS ocr_confidence,
         CASE WHEN d.doc_id % 97 = 13 THEN '   '
              WHEN d.doc_id % 89 = 5 THEN d.text || ' ' || chr(65533)
              ELSE d.text END AS content
  FROM (SELECT *, DATE '2026-01-01' + CAST((doc_id * 7) % 60 AS INTEGER) AS dt FROM documents) d
  LEFT JOIN labels l USING (doc_id)
)"""


def _staged(kb: str = "kb") -> str:
    return f"""composed AS (
  SELECT *, nfc_normalize(content) AS nfc, {_strip("effective_date")} AS day_text FROM {kb}
), trimmed AS (
  SELECT * REPLACE ({_collapse("nfc_normalize(title)")} AS title, {_collapse("nfc")} AS content),
         {_parsed("day_text")} AS parsed
  FROM composed
), staged AS (
  SELECT ingest_seq, doc_id, source_type, source_uri, title, version, ocr_confidence, content,
         CASE WHEN content = '' THEN effective_date
              ELSE coalesce(strftime(parsed, '%Y-%m-%d'), nullif(day_text, '')) END AS effective_date,
         CASE WHEN content = '' THEN NULL
              WHEN day_text IS NULL OR day_text = '' THEN 'missing'
              WHEN parsed IS NOT NULL THEN 'ok' ELSE 'invalid' END AS effective_date_status,
         contains(nfc, chr(65533)) AS has_replacement_char,
         CASE WHEN content = '' THEN NULL
              ELSE substr(sha256(source_type || '|' || doc_id || '|' || content), 1, 16)
              END AS content_hash
  FROM trimmed
)"""


_ROUTED = """copies AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source_type, content_hash
                               ORDER BY ingest_seq) AS copy_no
  FROM staged WHERE content <> ''
), ranked AS (
  SELECT *,
         row_number() OVER w AS place,
         first_value(effective_date_status = 'ok') OVER w AS best_dated,
         first_value(coalesce(nullif(version, ''), effective_date)) OVER w AS best_label,
         min(ingest_seq) OVER (PARTITION BY doc_id) AS group_seq
  FROM copies WHERE copy_no = 1
  WINDOW w AS (PARTITION BY doc_id
               ORDER BY effective_date_status = 'ok' DESC,
                        CASE WHEN effective_date_status = 'ok' THEN effective_date END DESC NULLS LAST,
                        ingest_seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), judged AS (
  SELECT ingest_seq, group_seq,
         CASE WHEN place > 1 AND best_dated THEN 'superseded_by_' || best_label
              WHEN place > 1 THEN 'superseded_no_date'
              WHEN effective_date_status = 'missing' THEN 'review_missing_date'
              WHEN ocr_confidence < 0.60 OR has_replacement_char THEN 'review_low_ocr' END AS reason
  FROM ranked
), routed AS (
  SELECT s.*, j.group_seq,
         CASE WHEN s.content = '' THEN 'empty_content'
              WHEN j.ingest_seq IS NULL THEN 'duplicate_content_hash'
              ELSE j.reason END AS reason,
         CASE WHEN s.content = '' OR j.ingest_seq IS NULL THEN 'reject'
              WHEN starts_with(j.reason, 'superseded') THEN 'reject'
              WHEN j.reason IS NOT NULL THEN 'flag' END AS action
  FROM staged s LEFT JOIN judged j USING (ingest_seq)
), cleaned AS (SELECT * REPLACE (group_seq AS ingest_seq) FROM routed WHERE action IS NULL)"""

_STAGED = f"WITH {_KB}, {_staged()}"
_ALL = f"{_STAGED}, {_ROUTED}"

_QUESTIONS = f"""asked AS (
  SELECT item_id AS question_id, text AS question,
         regexp_extract_all(lower(text), '{_WORD}') AS words
  FROM benchmark
), q_tf AS (
  SELECT question_id, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT question_id, unnest(words) AS term FROM asked) GROUP BY ALL
), q_norm AS (
  SELECT question_id, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS nq FROM q_tf GROUP BY ALL
), marked AS (
  SELECT question_id, question,
         list_filter(list_transform(range(1, len(words) + 1), lambda i:
             CASE WHEN length(words[i]) >= 4 AND list_position(words, words[i]) = i THEN words[i] END),
           lambda w: w IS NOT NULL) AS keywords
  FROM asked
), stale AS (
  SELECT question_id, CASE WHEN question_id % 4 = 1 THEN keywords[1] END AS stale_marker FROM marked
)"""


def _store(name: str, rows: str) -> str:
    """Chunks, term counts, norms and all scores of one set of knowledge rows."""
    return f"""{name} AS (
  SELECT ingest_seq AS chunk_order, doc_id, version, effective_date, content AS text
  FROM {rows} WHERE source_type = 'file' AND NOT {_blank("content")}
), {name}_tf AS (
  SELECT chunk_order, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT chunk_order, unnest(regexp_extract_all(lower(text), '{_WORD}')) AS term FROM {name})
  GROUP BY ALL
), {name}_norm AS (
  SELECT c.chunk_order, sqrt(CAST(coalesce(sum(tf * tf), 0) AS DOUBLE)) AS norm
  FROM {name} c LEFT JOIN {name}_tf t USING (chunk_order) GROUP BY ALL
)"""


def _scores(name: str) -> str:
    return f"""{name}_scores AS (
  SELECT question_id, chunk_order, CAST(dot AS DOUBLE) / (nq * norm) AS score
  FROM (SELECT question_id, chunk_order, CAST(sum(q.tf * t.tf) AS BIGINT) AS dot
        FROM q_tf q JOIN {name}_tf t USING (term) GROUP BY ALL)
  JOIN q_norm USING (question_id) JOIN {name}_norm USING (chunk_order)
), {name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_order) AS rank
  FROM {name}_scores
), {name}_answers AS (
  SELECT question_id, question,
         coalesce(c.text, 'Không tìm thấy thông tin trong cơ sở tri thức.') AS answer,
         coalesce(c.doc_id, '-') AS cited_doc, c.version AS cited_version,
         c.effective_date AS cited_date, coalesce(r.score, 0.0::DOUBLE) AS score,
         list_bool_and(list_transform(keywords, lambda k: contains(lower(
           coalesce(c.text, 'Không tìm thấy thông tin trong cơ sở tri thức.')), lower(k))))
           AND NOT coalesce(contains(lower(c.text), lower(stale_marker)), false) AS all_in,
         keywords
  FROM marked JOIN stale USING (question_id) LEFT JOIN (SELECT * FROM {name}_ranked WHERE rank = 1) r USING (question_id)
  LEFT JOIN {name} c USING (chunk_order)
)"""


_RAW_STORE = f"{_STAGED}, {_store('raw_kb', 'kb')}"
_RAW_SEARCH = f"{_RAW_STORE}, {_QUESTIONS}, {_scores('raw_kb')}"
_CLEAN_SEARCH = f"{_ALL}, {_QUESTIONS}, {_store('clean_kb', 'cleaned')}, {_scores('clean_kb')}"
_BOTH_SEARCH = f"{_CLEAN_SEARCH}, {_store('raw_kb', 'kb')}, {_scores('raw_kb')}"

_EVALUATION = f"""evaluation AS (
  SELECT '{RUN_ID}' AS run_id, b.question_id, b.question,
         b.answer AS before_answer, b.cited_doc AS before_doc,
         coalesce(b.all_in, true) AS before_correct,
         a.answer AS after_answer, a.cited_doc AS after_doc, a.cited_version AS after_version,
         a.cited_date AS after_effective_date, coalesce(a.all_in, true) AS after_correct
  FROM raw_kb_answers b JOIN clean_kb_answers a USING (question_id)
)"""


def _reason(condition: str, prefix: str = _ALL) -> str:
    return f"{prefix} SELECT ingest_seq, doc_id, source_type, action, reason FROM routed WHERE {condition}"


def _freshness(loads: str, sla: str) -> str:
    return f"""SELECT 'freshness' AS pillar, 'freshness[' || source_type || ']' AS name,
       CASE WHEN hours IS NULL OR hours >= sla THEN 'PAGE' WHEN hours >= sla * 0.5 THEN 'WARN' ELSE 'PASS' END AS status,
       hours AS value, 'SLA=' || CAST(CAST(sla AS DECIMAL(10,1)) AS VARCHAR) || 'h' AS detail
FROM (SELECT *, {sla} AS sla FROM ({loads}))"""


_EVENT_LOADS = f"""SELECT event_type AS source_type,
  CAST(epoch_us({_EVENTS_NOW}) - epoch_us(max(ts)) AS DOUBLE) / 1e6 / 3600.0::DOUBLE AS hours
  FROM events GROUP BY event_type"""

_CHECKS = f"""facts AS (
  SELECT count(*) AS n,
         count(*) FILTER (effective_date IS NULL OR effective_date = '') AS undated,
         min(length(content)) AS lo, CAST(trunc(median(length(content))) AS BIGINT) AS mid,
         max(length(content)) AS hi, count(DISTINCT doc_id) AS keys,
         count(*) FILTER (has_replacement_char) AS noisy
  FROM cleaned
), loads AS (
  SELECT source_type, count(*) AS n_rows,
         CAST(epoch_us({_NOW}) - epoch_us(CAST(max(effective_date) FILTER (
           effective_date_status = 'ok') AS TIMESTAMP)) AS DOUBLE) / 1e6 / 3600.0::DOUBLE AS hours
  FROM staged GROUP BY source_type
), volumes AS (
  SELECT l.source_type, l.n_rows, b.n_rows AS base,
         CAST(l.n_rows - b.n_rows AS DOUBLE) / CAST(b.n_rows AS DOUBLE) * 100.0::DOUBLE AS delta
  FROM loads l LEFT JOIN (
    SELECT source_type, count(*) AS n_rows FROM staged
    WHERE effective_date_status = 'ok' AND effective_date < '{BASELINE_BEFORE}' GROUP BY source_type
  ) b USING (source_type)
), checks AS (
  {_freshness("SELECT source_type, hours FROM loads", "4.0")}
  UNION ALL
  SELECT 'volume', 'volume[' || source_type || ']',
         CASE WHEN abs(delta) >= 20 THEN 'WARN' ELSE 'PASS' END, CAST(n_rows AS DOUBLE),
         coalesce('baseline=' || CAST(base AS VARCHAR) || ' change=' || CAST(CAST(delta AS DECIMAL(20,1)) AS VARCHAR) || '%', 'no baseline yet') FROM volumes
  UNION ALL
  SELECT 'distribution', 'null_rate[effective_date]',
         CASE WHEN n = 0 OR CAST(undated AS DOUBLE) / n * 100.0::DOUBLE >= 10 THEN 'WARN' ELSE 'PASS' END,
         CAST(undated AS DOUBLE) / n * 100.0::DOUBLE,
         CASE WHEN n = 0 THEN 'empty batch'
              ELSE CAST(undated AS VARCHAR) || '/' || CAST(n AS VARCHAR) || ' rows null' END FROM facts
  UNION ALL
  SELECT 'distribution', 'content_length', 'PASS', CAST(mid AS DOUBLE),
         'min=' || CAST(lo AS VARCHAR) || ' median=' || CAST(mid AS VARCHAR) || ' max=' || CAST(hi AS VARCHAR)
  FROM facts WHERE n > 0
  UNION ALL
  SELECT 'distribution', 'ocr_noise', 'WARN', CAST(noisy AS DOUBLE), 'replacement characters'
  FROM facts WHERE noisy > 0
  UNION ALL
  SELECT 'distribution', 'cardinality[doc_id]', 'PASS', CAST(keys AS DOUBLE), 'unique doc_ids'
  FROM facts WHERE keys > 0
  UNION ALL
  SELECT 'schema', 'schema_contract', 'PASS', 0.0::DOUBLE, 'stable'
)"""

_LINEAGE = f"""edges AS (
  SELECT '{RUN_ID}' AS run_id, 'source:' || source_type AS from_node, 'raw' AS to_node,
         count(*) AS n_rows FROM staged GROUP BY source_type
  UNION ALL SELECT '{RUN_ID}', 'raw', 'cleaned', count(*) FROM cleaned
  UNION ALL SELECT '{RUN_ID}', 'cleaned', 'vector_store', count(*) FROM cleaned WHERE source_type = 'file'
)"""

_FUNNEL = """funnel AS (
  SELECT count(*) AS raw,
         count(*) FILTER (reason = 'empty_content') AS dropped_empty,
         count(*) FILTER (reason = 'duplicate_content_hash') AS dropped_duplicates,
         count(*) FILTER (starts_with(reason, 'superseded')) AS dropped_superseded,
         count(*) FILTER (reason = 'review_missing_date') AS flagged_missing_date,
         count(*) FILTER (reason = 'review_low_ocr') AS flagged_low_ocr,
         count(*) FILTER (has_replacement_char AND content <> '') AS flagged_encoding,
         count(*) FILTER (effective_date_status = 'invalid') AS invalid_date,
         count(*) FILTER (action IS NULL) AS cleaned,
         count(*) FILTER (action IS NOT NULL) AS quarantined
  FROM routed
)"""

_ISO = r"^\d{4}-\d{2}-\d{2}$"


def _broken(rows: str) -> str:
    """Offending values of the suite's five expectations."""
    valid = f"regexp_full_match(effective_date, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') AND try_strptime(effective_date, '%Y-%m-%d') IS NOT NULL"
    return f"""broken AS (
  SELECT 0 AS ordinal, 'not_null' AS name, 'content' AS "column", ingest_seq AS seq,
         substr(content, 1, 120) AS value FROM {rows} WHERE {_blank("content")}
  UNION ALL
  SELECT 1, 'unique', 'doc_id', min(ingest_seq), doc_id FROM {rows} GROUP BY doc_id HAVING count(*) > 1
  UNION ALL
  SELECT 2, 'not_null', 'effective_date', ingest_seq, effective_date FROM {rows}
  WHERE {_blank("effective_date")}
  UNION ALL
  SELECT 3, 'match_regex', 'effective_date', ingest_seq, effective_date FROM {rows}
  WHERE NOT coalesce(regexp_matches(effective_date, '{_ISO}'), false)
  UNION ALL
  SELECT 4, 'valid_date', 'effective_date', ingest_seq, effective_date FROM {rows}
  WHERE NOT coalesce({valid}, false)
), samples AS (
  SELECT * EXCLUDE (seq) FROM (
    SELECT ordinal, name, "column",
           CAST(row_number() OVER (PARTITION BY ordinal ORDER BY seq) AS INTEGER) AS position,
           value, seq
    FROM broken) WHERE position <= 3
), suite AS (
  SELECT ordinal, name, "column", count(b.ordinal) = 0 AS success, count(b.ordinal) AS unexpected
  FROM (VALUES (0, 'not_null', 'content'), (1, 'unique', 'doc_id'), (2, 'not_null', 'effective_date'),
               (3, 'match_regex', 'effective_date'), (4, 'valid_date', 'effective_date')
       ) e(ordinal, name, "column")
  LEFT JOIN (SELECT ordinal FROM broken) b USING (ordinal) GROUP BY ALL
)"""


def _expectation(ordinal_map: dict[int, int]) -> str:
    """Single expectations over the staged rows, renumbered as the query orders them."""
    cases = " ".join(f"WHEN {old} THEN {new}" for old, new in ordinal_map.items())
    wanted = ", ".join(str(o) for o in ordinal_map)
    return f"""{_STAGED}, {_broken("staged")}
SELECT CAST(CASE ordinal {cases} END AS INTEGER) AS ordinal, name, "column", success, unexpected
FROM suite WHERE ordinal IN ({wanted})"""


_REPORT_SECTIONS = f"""listed AS (
  SELECT ordinal, 'e.g. ' || string_agg(coalesce(value, 'null'), ', ' ORDER BY position) AS detail
  FROM samples GROUP BY ordinal
), report AS (
  SELECT 'run' AS section, 'run_status' AS item,
         CASE WHEN bool_and(success) THEN 'PUBLISHED' ELSE 'HALTED' END AS status, NULL::DOUBLE AS value,
         coalesce('bad data before agent -> ' || string_agg(name || '(' || "column" || ')=' || unexpected, '; '
           ORDER BY ordinal) FILTER (NOT success), '') AS detail FROM suite
  UNION ALL
  SELECT 'run', 'embedded_records', '', CAST(n_rows AS DOUBLE), '' FROM edges WHERE to_node = 'vector_store'
  UNION ALL
  SELECT 'funnel' AS section, name AS item, '' AS status, CAST(value AS DOUBLE) AS value, '' AS detail
  FROM (UNPIVOT funnel ON COLUMNS(*) INTO NAME name VALUE value)
  UNION ALL
  SELECT 'suite', name || '(' || "column" || ')', CASE WHEN success THEN 'PASS' ELSE 'FAIL' END,
         CAST(unexpected AS DOUBLE), coalesce(detail, '') FROM suite LEFT JOIN listed USING (ordinal)
  UNION ALL SELECT 'checks', name, status, value, detail FROM checks
  UNION ALL SELECT 'lineage', from_node || ' -> ' || to_node, '', CAST(n_rows AS DOUBLE), '' FROM edges
  UNION ALL
  SELECT 'evaluation', CAST(question_id AS VARCHAR), CASE WHEN after_correct THEN 'CORRECT' ELSE 'WRONG' END,
         CAST(CAST(before_correct AS INTEGER) + CAST(after_correct AS INTEGER) AS DOUBLE),
         before_doc || ' -> ' || after_doc FROM evaluation
)"""

_UNDATED = f"""WITH {_KB}, undated AS (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS effective_date) FROM kb),
{_staged("undated")}, {_ROUTED}"""

ORACLE: dict[str, str] = {
    "canonicalize": f"WITH {_KB} SELECT * FROM kb",
    "union_sources": f"""WITH {_KB} SELECT
        (CASE source_type WHEN 'postgres' THEN 0 WHEN 'jira' THEN 1 ELSE 2 END)::BIGINT
          * 288230376151711744 + ingest_seq AS ingest_seq, doc_id, source_type, title FROM kb""",
    "source_counts": f"""WITH {_KB} SELECT source_type, count(kb.ingest_seq) AS n_rows
        FROM (VALUES ('postgres'), ('jira'), ('file')) s(source_type)
        FULL JOIN kb USING (source_type) GROUP BY ALL""",
    "cleaned_rows": f"""{_ALL} SELECT ingest_seq, doc_id, source_type, source_uri, title,
        effective_date, version, ocr_confidence, content, effective_date_status, content_hash
        FROM cleaned""",
    "quarantine_rows": f"""{_ALL} SELECT '{RUN_ID}' AS run_id, doc_id, source_type, source_uri,
        action, reason, substr(content, 1, 120) AS content FROM routed WHERE action IS NOT NULL""",
    "classify_rows": f"""{_ALL} SELECT ingest_seq, doc_id, source_type, effective_date,
        effective_date_status, content_hash, action, reason, group_seq FROM routed""",
    "record_funnel": f"{_ALL}, {_FUNNEL} SELECT * FROM funnel",
    "nfc_text": """SELECT doc_id, nfc_normalize(t) AS text_nfc, t <> nfc_normalize(t) AS changed
        FROM (SELECT doc_id, replace(text, chr(233), 'e' || chr(769)) AS t FROM documents)""",
    "collapse_whitespace": f"SELECT doc_id, {_collapse('text')} AS text_collapsed FROM documents",
    "parse_dates": f"""WITH {_KB}, d AS (SELECT *, {_strip("effective_date")} AS t FROM kb),
        p AS (SELECT *, {_parsed("t")} AS parsed FROM d)
        SELECT ingest_seq, effective_date, coalesce(strftime(parsed, '%Y-%m-%d'), nullif(t, '')) AS iso_date,
               CASE WHEN t IS NULL OR t = '' THEN 'missing' WHEN parsed IS NULL THEN 'invalid' ELSE 'ok' END
               AS status FROM p""",
    "date_status_counts": f"""WITH {_KB}, d AS (SELECT *, {_strip("effective_date")} AS t FROM kb)
        SELECT CASE WHEN t IS NULL OR t = '' THEN 'missing' WHEN {_parsed("t")} IS NULL THEN 'invalid'
               ELSE 'ok' END AS status, count(*) AS n_rows FROM d GROUP BY ALL""",
    "mojibake_flag": f"{_STAGED} SELECT ingest_seq, has_replacement_char FROM staged",
    "content_hash": f"{_STAGED} SELECT ingest_seq, content_hash FROM staged",
    "tokenize_counts": f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens,
        CAST(len(list_distinct(t)) AS BIGINT) AS n_terms, array_to_string(t, ' ') AS joined
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '{_WORD}') AS t FROM documents)""",
    "empty_content": _reason("reason = 'empty_content'"),
    "dedupe_exact": _reason("reason = 'duplicate_content_hash'"),
    "supersede_latest": _reason("starts_with(reason, 'superseded_by_')"),
    "supersede_no_date": _reason("reason = 'superseded_no_date'", _UNDATED),
    "flag_missing_date": _reason("reason = 'review_missing_date'"),
    "flag_low_ocr": _reason("reason = 'review_low_ocr'"),
    "kb_documents": f"""{_ALL} SELECT ingest_seq, doc_id, source_uri, version, effective_date, content
        FROM cleaned WHERE source_type = 'file' AND NOT {_blank("content")}""",
    "freshness_status": _freshness(_EVENT_LOADS, "4.0"),
    "freshness_per_source_sla": _freshness(
        _EVENT_LOADS, "CASE source_type WHEN 'error' THEN 0.5 WHEN 'purchase' THEN 1.0 ELSE 4.0 END"
    ),
    "volume_vs_baseline": """WITH daily AS (
          SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events GROUP BY ALL),
        paired AS (SELECT d.event_type, d.day, d.n_rows, b.n_rows AS base,
          CAST(d.n_rows - b.n_rows AS DOUBLE) / CAST(b.n_rows AS DOUBLE) * 100.0::DOUBLE AS delta_pct
          FROM daily d LEFT JOIN daily b ON b.event_type = d.event_type AND b.day = d.day - 1)
        SELECT event_type, strftime(day, '%Y-%m-%d') AS day, n_rows, base, delta_pct,
               CASE WHEN abs(delta_pct) >= 20 THEN 'WARN' ELSE 'PASS' END AS status FROM paired""",
    "null_rate": f"""WITH {_KB}, f AS (SELECT count(*) AS n,
          count(*) FILTER (effective_date IS NULL OR effective_date = '') AS undated FROM kb)
        SELECT n, undated, CAST(undated AS DOUBLE) / n * 100.0::DOUBLE AS null_rate_pct,
               CASE WHEN CAST(undated AS DOUBLE) / n * 100.0::DOUBLE >= 10 THEN 'WARN' ELSE 'PASS' END
               AS status FROM f""",
    "content_length_stats": f"""WITH {_KB} SELECT min(length(content)) AS min_length,
        CAST(trunc(median(length(content))) AS BIGINT) AS median_length,
        max(length(content)) AS max_length FROM kb""",
    "key_cardinality": f"WITH {_KB} SELECT count(DISTINCT doc_id) AS doc_ids FROM kb",
    "mojibake_count": f"""WITH {_KB} SELECT 'distribution' AS pillar, 'ocr_noise' AS name,
        'WARN' AS status, CAST(count(*) AS DOUBLE) AS value, 'replacement characters' AS detail
        FROM kb WHERE contains(content, chr(65533)) HAVING count(*) > 0""",
    "schema_drift": """SELECT key, count(*) FILTER (NOT list_contains(json_keys(props), key)) AS n_missing,
        count(*) AS n_rows FROM events, (VALUES ('k'), ('source')) k(key) GROUP BY key""",
    "schema_check": """WITH d AS (SELECT key FROM events, (VALUES ('k'), ('source')) k(key)
          WHERE NOT list_contains(json_keys(props), key) GROUP BY key)
        SELECT 'schema' AS pillar, 'schema_contract' AS name, CASE WHEN count(*) > 0 THEN 'PAGE' ELSE 'PASS' END AS status,
               CAST(count(*) AS DOUBLE) AS value,
               coalesce('missing: ' || string_agg(key, ', ' ORDER BY key), 'stable') AS detail FROM d""",
    "low_ocr_warn": f"""WITH {_KB}, f AS (SELECT count(*) AS n, count(*) FILTER (
          ocr_confidence >= 0.50 AND ocr_confidence < 0.90) AS low FROM kb)
        SELECT 'distribution' AS pillar, 'low_ocr' AS name,
               CASE WHEN low > 0 THEN 'WARN' ELSE 'PASS' END AS status, CAST(low AS DOUBLE) AS value,
               CAST(low AS VARCHAR) || '/' || CAST(n AS VARCHAR) || ' rows below comfortable OCR' AS detail
        FROM f""",
    "lineage_edges": f"{_ALL}, {_LINEAGE} SELECT * FROM edges",
    "monitor_report": f"{_ALL}, {_CHECKS} SELECT * FROM checks",
    "worst_status": f"""{_ALL}, {_CHECKS} SELECT CASE max(CASE status WHEN 'PAGE' THEN 2 WHEN 'WARN' THEN 1
        ELSE 0 END) WHEN 2 THEN 'PAGE' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS worst FROM checks""",
    "expect_not_null": _expectation({0: 0, 2: 1}),
    "expect_unique": _expectation({1: 0}),
    "expect_match_regex": _expectation({3: 0}),
    "expect_valid_date": _expectation({4: 0}),
    "expectation_samples": f"{_STAGED}, {_broken('staged')} SELECT * FROM samples",
    "expectation_suite": f"{_ALL}, {_broken('cleaned')} SELECT * FROM suite",
    "term_frequency": f"{_RAW_STORE} SELECT chunk_order, term, tf FROM raw_kb_tf",
    "doc_norms": f"{_RAW_STORE} SELECT chunk_order, norm FROM raw_kb_norm",
    "cosine_scores": f"""{_RAW_SEARCH} SELECT question_id, chunk_order, score FROM raw_kb_scores
        WHERE score >= {SIMILAR_FROM}""",
    "retrieve_topk": f"""{_RAW_SEARCH}, every_pair AS (
          SELECT question_id, chunk_order, coalesce(score, 0.0::DOUBLE) AS score
          FROM (SELECT question_id, chunk_order FROM asked, raw_kb)
          LEFT JOIN raw_kb_scores USING (question_id, chunk_order)),
        r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_order) AS rank
          FROM every_pair)
        SELECT question_id, rank, chunk_order, score FROM r WHERE rank <= 5""",
    "answer_top1": f"""{_RAW_SEARCH} SELECT question_id, answer, cited_doc, cited_version, cited_date,
        score FROM raw_kb_answers""",
    "answer_correctness": f"""{_RAW_SEARCH} SELECT question_id, cited_doc,
        coalesce(all_in, true) AS correct FROM raw_kb_answers""",
    "before_after_eval": f"{_BOTH_SEARCH}, {_EVALUATION} SELECT * FROM evaluation",
    "hit_at_k": f"""{_BOTH_SEARCH} SELECT question_id, cited_doc AS expect_doc, EXISTS (
          SELECT 1 FROM clean_kb_ranked r JOIN clean_kb c USING (chunk_order)
          WHERE r.question_id = a.question_id AND r.rank <= 5 AND c.doc_id = a.cited_doc) AS hit
        FROM raw_kb_answers a""",
    "citation_age_p95": f"""{_CLEAN_SEARCH} SELECT count(*) AS n_citations,
        quantile_cont(age, 0.95) AS age_days_p95 FROM (
          SELECT CAST(date_diff('day', CAST(try_strptime(cited_date, '%Y-%m-%d') AS DATE),
                      CAST({_NOW} AS DATE)) AS DOUBLE) AS age FROM clean_kb_answers) WHERE age IS NOT NULL""",
    "quality_report": f"""{_BOTH_SEARCH}, {_EVALUATION}, {_FUNNEL}, {_CHECKS}, {_LINEAGE},
        {_broken("cleaned")}, {_REPORT_SECTIONS} SELECT '{RUN_ID}' AS run_id, * FROM report""",
}


_ISSUES_BACK = f"""WITH {_KB} SELECT doc_id, source_type, 'jira/' || doc_id AS source_uri, title,
        effective_date, CAST(NULL AS VARCHAR) AS version, 1.0::DOUBLE AS ocr_confidence, content
        FROM kb WHERE source_type = 'jira'"""


def _published(condition: str) -> str:
    """Cleaned records of a run over the sources that meet the condition, unreadable days left out;
    positions as `union_sources` gives them."""
    return f"""WITH {_KB}, mended AS (
  SELECT * REPLACE (nullif(effective_date, '2026-13-45') AS effective_date,
    (CASE source_type WHEN 'postgres' THEN 0 WHEN 'jira' THEN 1 ELSE 2 END)::BIGINT * 288230376151711744 + ingest_seq AS ingest_seq)
  FROM kb WHERE {condition}
), {_staged("mended")}, {_ROUTED}"""


_STORED = "SELECT ingest_seq AS chunk_order, doc_id, version, effective_date, content AS text"
_HALTING = f"""WITH {_KB}, moved AS (
  SELECT * REPLACE ((CASE source_type WHEN 'postgres' THEN 0 WHEN 'jira' THEN 1 ELSE 2 END)::BIGINT * 288230376151711744 + ingest_seq AS ingest_seq)
  FROM kb
), {_staged("moved")}, {_ROUTED}, {_broken("cleaned")}"""

ORACLE |= {
    "csv_round_trip": f"""WITH {_KB} SELECT doc_id, source_type, source_uri, title, effective_date,
        CASE source_type WHEN 'file' THEN version END AS version,
        CASE source_type WHEN 'file' THEN ocr_confidence ELSE 1.0::DOUBLE END AS ocr_confidence, content
        FROM kb WHERE source_type IN ('postgres', 'file')""",
    "issues_round_trip": _ISSUES_BACK,
    "issue_arrays": _ISSUES_BACK,
    "csv_positions": f"""WITH {_KB}, t AS (SELECT *, ingest_seq // 1000 AS shard FROM kb WHERE source_type = 'postgres')
        SELECT (dense_rank() OVER (ORDER BY shard) - 1) * 8589934592 + 1
          + row_number() OVER (PARTITION BY shard ORDER BY ingest_seq) AS ingest_seq, doc_id, source_uri, content FROM t""",
    "raw_snapshot": f"WITH {_KB} SELECT * FROM kb",
    "published_store": f"""{_published("source_type IN ('jira', 'file')")} {_STORED}
        FROM cleaned WHERE source_type = 'file'""",
    "published_topk": f"""{_published("source_type IN ('jira', 'file')")}, {_QUESTIONS}, {_store('pub', 'cleaned')},
        {_scores('pub')} SELECT question_id, rank, chunk_order, score FROM pub_ranked WHERE rank <= 5""",
    "baseline_after_publish": f"""WITH {_KB} SELECT s.source_type,
        count(kb.ingest_seq) FILTER (s.source_type <> 'postgres') AS n_rows
        FROM (VALUES ('postgres'), ('jira'), ('file')) s(source_type)
        LEFT JOIN kb ON kb.source_type = s.source_type GROUP BY ALL""",
    "run_state_after_halt": """SELECT * FROM (VALUES
        (0::BIGINT, '2026-03-01T03:00', 'PUBLISHED', '2026-03-01T03:00', true),
        (1::BIGINT, '2026-03-02T03:00', 'PUBLISHED', '2026-03-02T03:00', true),
        (2::BIGINT, '2026-03-02T03:00', 'HALTED', '2026-03-02T03:00', false)
        ) t(seq, run_id, status, last_success_run, readers_see_it)""",
    "gate_reason": f"""{_HALTING} SELECT '2026-03-02T03:00' AS run_id, 'run_status' AS item, 'HALTED' AS status,
        NULL::DOUBLE AS value, 'bad data before agent -> ' || string_agg(name || '(' || "column" || ')=' || unexpected,
          '; ' ORDER BY ordinal) FILTER (NOT success) AS detail FROM suite
        UNION ALL SELECT '2026-03-02T03:00', 'embedded_records', '', 0.0::DOUBLE, ''""",
    "rolled_back_store": f"""{_published("true")} SELECT ingest_seq AS chunk_order, doc_id, 'v0' AS version,
        effective_date, content AS text, 'file' AS source FROM cleaned WHERE source_type = 'file'""",
    "approximate_keys": f"WITH {_KB} SELECT count(DISTINCT doc_id) AS doc_ids, true AS is_near FROM kb",
    "approximate_median": f"""WITH {_KB} SELECT count(*) AS n_rows, min(length(content)) AS min_length,
        max(length(content)) AS max_length, true AS is_near FROM kb""",
    "evaluation_csv": f"""{_published("true")}, {_QUESTIONS}, {_store('clean_kb', 'cleaned')}, {_scores('clean_kb')},
        {_store('raw_kb', 'mended')}, {_scores('raw_kb')}, {_EVALUATION} SELECT * FROM evaluation""",
    "load_times": f"""WITH {_KB} SELECT source_type, count(*) AS n_rows,
        CASE source_type WHEN 'postgres' THEN 3.0::DOUBLE WHEN 'file' THEN 0.75::DOUBLE END AS hours
        FROM kb GROUP BY source_type""",
    "empty_batch": f"""WITH {_KB} SELECT 'distribution' AS pillar, 'null_rate[effective_date]' AS name, 'WARN' AS status,
        NULL::DOUBLE AS value, 'empty batch' AS detail FROM kb WHERE source_type NOT IN ('postgres', 'jira', 'file')
        HAVING count(*) = 0""",
}
