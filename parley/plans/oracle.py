"""DuckDB oracle SQL for every registered query.

Independent formulations: they compute the expected answer straight from the
registered tables under the fixture rules (FIXTURES.md §2) — no JSON is
generated or parsed here, so the oracle does not share the engine's parse path.
"""

from __future__ import annotations

from parley.operators.template import TOKEN_PATTERN

PAT = TOKEN_PATTERN.replace("'", "''")
NL = "chr(10)"

# Raw-line fixture outcome per conversation, and the messages each ok line yields.
LINES = f"""
c_agg AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(text, {NL} || {NL} ORDER BY turn) FILTER (WHERE role = 'user') AS u_text,
         string_agg(text, {NL} || {NL} ORDER BY turn) FILTER (WHERE role = 'assistant') AS a_text,
         string_agg(text, {NL} || {NL} ORDER BY turn) FILTER (WHERE role = 'system') AS s_text
  FROM conversations GROUP BY conv_id),
lines AS (
  SELECT conv_id,
         CASE WHEN conv_id % 5 = 0 THEN 'team_identity.jsonl'
              ELSE 'general_' || CAST(conv_id % 4 AS VARCHAR) || '.jsonl' END AS file,
         CASE conv_id % 3 WHEN 0 THEN 'messages' WHEN 1 THEN 'conversation' ELSE 'instruction' END AS shape,
         CASE WHEN conv_id % 11 = 3 THEN 'json_error'
              WHEN conv_id % 3 IN (0, 1) AND (conv_id % 11 = 7 OR n_turns < 2) THEN 'too_few_messages'
              WHEN conv_id % 3 = 2 AND (conv_id % 11 = 7 OR a_text IS NULL OR u_text IS NULL) THEN 'empty_instruction'
              ELSE 'ok' END AS outcome,
         CASE WHEN conv_id % 5 = 0 THEN 2 ELSE 1 END AS mult,
         u_text, a_text, s_text
  FROM c_agg),
msgs AS (
  SELECT l.conv_id, l.shape, CAST(row_number() OVER (PARTITION BY l.conv_id ORDER BY c.turn) - 1 AS BIGINT) AS pos,
         c.role, c.text AS content
  FROM lines l JOIN conversations c ON c.conv_id = l.conv_id
  WHERE l.outcome = 'ok' AND l.shape IN ('messages', 'conversation')
  UNION ALL
  SELECT conv_id, shape, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1 AS BIGINT) AS pos, role, content
  FROM (SELECT conv_id, shape, 0 AS k, 'system' AS role, s_text AS content FROM lines
          WHERE outcome = 'ok' AND shape = 'instruction' AND s_text IS NOT NULL
        UNION ALL SELECT conv_id, shape, 1, 'user', u_text FROM lines WHERE outcome = 'ok' AND shape = 'instruction'
        UNION ALL SELECT conv_id, shape, 2, 'assistant', a_text FROM lines WHERE outcome = 'ok' AND shape = 'instruction')),
prep AS (
  SELECT l.conv_id, l.file, l.mult, contains(string_agg(m.content, ' ' ORDER BY m.pos), 'ung') AS flag,
         count(*) AS n_messages
  FROM lines l JOIN msgs m ON m.conv_id = l.conv_id
  GROUP BY l.conv_id, l.file, l.mult),
prep_rows AS (
  SELECT conv_id, file, flag, n_messages, CAST(unnest(range(1, mult + 1)) AS BIGINT) AS replica FROM prep)
"""

COVERAGE = """
cov AS (
  SELECT count(*) FILTER (WHERE flag) AS n_key, count(*) AS n_total FROM prep_rows),
cov2 AS (
  SELECT n_key, n_total,
         CASE WHEN n_total = 0 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * n_key::DOUBLE / n_total::DOUBLE END AS pct
  FROM cov)
"""

MANIFEST = """
manifest AS (
  SELECT 'runs/' || source || '/' || lang || '/' ||
         CASE doc_id % 6 WHEN 0 THEN CAST(doc_id AS VARCHAR) || '.jsonl'
                         WHEN 1 THEN CAST(doc_id AS VARCHAR) || '.md'
                         WHEN 2 THEN 'optimizer.pt'
                         WHEN 3 THEN 'x.tmp'
                         WHEN 4 THEN 'checkpoint-' || CAST(doc_id AS VARCHAR) || '/adapter.bin'
                         ELSE CAST(doc_id AS VARCHAR) || '.JSONL' END AS path,
         n_chars AS length, doc_id
  FROM documents)
"""

CONV_FLAG = """
cflag AS (
  SELECT conv_id, contains(string_agg(text, ' ' ORDER BY turn), 'ung') AS flag
  FROM conversations GROUP BY conv_id)
"""

RENDER = f"""
rend AS (
  SELECT conv_id,
         string_agg('<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL}, '' ORDER BY turn) AS text,
         arg_min(text, turn) FILTER (WHERE role = 'assistant') AS first_response
  FROM conversations GROUP BY conv_id),
toks AS (
  SELECT conv_id, text, first_response, regexp_extract_all(text, '{PAT}') AS t FROM rend),
pos AS (
  SELECT conv_id, t,
         coalesce(list_min(list_filter(range(0, len(t) - 1),
                  lambda i: t[i + 1] = '<|im_start|>' AND t[i + 2] = 'assistant')), -1) AS first_pos,
         coalesce(list_max(list_filter(range(0, len(t) - 1),
                  lambda i: t[i + 1] = '<|im_start|>' AND t[i + 2] = 'assistant')), -1) AS last_pos
  FROM toks),
mask AS (
  SELECT conv_id, t, CASE WHEN last_pos >= 0 THEN last_pos + 2 END AS mask_start FROM pos)
"""


def _split_sql(units: str, key_expr: str, order_expr: str, kid: str, kother: str) -> str:
    """Row-number the units per flag by the seeded hash and cut at the quotas."""
    return f"""
cnt AS (SELECT count(*) FILTER (WHERE flag) AS n_id, count(*) FILTER (WHERE NOT flag) AS n_other FROM {units}),
q AS (SELECT {kid} AS k_id, {kother} AS k_other FROM cnt),
ranked AS (
  SELECT {key_expr}, flag, row_number() OVER (PARTITION BY flag ORDER BY {order_expr}) AS rn FROM {units}),
sp AS (
  SELECT ranked.*, CASE WHEN (flag AND rn <= k_id) OR (NOT flag AND rn <= k_other) THEN 'eval' ELSE 'train' END AS split
  FROM ranked, q)
"""


QA_ID = "least(30, greatest(5, n_id // 10))"
QA_OTHER = "greatest(least(300 - least(30, greatest(5, n_id // 10)), n_other // 20), 0)"
QB_ID = "least(30, n_id // 2)"
QB_OTHER = "least(270, n_other // 2)"

SPLIT_A = _split_sql("cflag", "conv_id", "md5('42:' || CAST(conv_id AS VARCHAR)), conv_id", QA_ID, QA_OTHER)
SPLIT_B = _split_sql("cflag", "conv_id", "md5('42:' || CAST(conv_id AS VARCHAR)), conv_id", QB_ID, QB_OTHER)

RUNLOG = """
ev AS (
  SELECT CASE WHEN user_id % 10 <> 3 THEN user_id END AS run_id, ts, event_id,
         CASE WHEN event_id % 40 <> 7 THEN value END AS eval_loss FROM events),
rl AS (
  SELECT run_id,
         CAST(row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS BIGINT) AS step,
         eval_loss,
         (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY run_id)))::DOUBLE / 1000000.0::DOUBLE AS elapsed,
         CAST(ceil(count(*) OVER (PARTITION BY run_id) / 100) * 100 AS BIGINT) AS max_steps
  FROM ev),
ck AS (
  SELECT run_id, step, eval_loss,
         'run-' || coalesce(CAST(run_id AS VARCHAR), 'none') || '/checkpoint-' || CAST(step * 10 AS VARCHAR) AS path
  FROM rl)
"""

SESSION = """
st AS (
  SELECT conv_id, turn, role,
         CASE WHEN role = 'user' AND conv_id % 4 = 1 AND turn = 4 THEN ' /CLEAR '
              WHEN role = 'user' AND conv_id % 4 = 2 AND turn = 2 THEN '/History'
              WHEN role = 'user' AND conv_id % 4 = 3 AND turn = 6 THEN ' /exit'
              WHEN role = 'user' AND conv_id % 5 = 0 THEN chr(160) || ' ' || text || chr(9) || ' '
              WHEN role <> 'user' AND conv_id % 5 = 1 THEN chr(10) || text || ' ' || chr(10)
              ELSE text END AS typed
  FROM conversations WHERE role IN ('user', 'assistant')),
sv AS (SELECT conv_id, turn, role, trim(typed, ' ' || chr(9) || chr(10) || chr(160)) AS text FROM st),
kd AS (
  SELECT *, CASE WHEN role <> 'user' THEN 'response'
                 WHEN lower(trim(text)) = '' THEN 'skip'
                 WHEN lower(trim(text)) = '/exit' THEN 'exit'
                 WHEN lower(trim(text)) = '/clear' THEN 'clear'
                 WHEN lower(trim(text)) = '/history' THEN 'history'
                 ELSE 'message' END AS kind
  FROM sv),
ep0 AS (
  SELECT *, CAST(sum(CASE WHEN kind = 'clear' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS epoch,
         max(CASE WHEN kind = 'exit' THEN 1 ELSE 0 END) OVER w AS exited
  FROM kd WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ep AS (SELECT conv_id, turn, role, text, kind, epoch FROM ep0 WHERE exited = 0)
"""


def _history(cap: int) -> str:
    return f"""
hm AS (SELECT * FROM ep WHERE kind IN ('message', 'response')),
hh AS (
  SELECT conv_id, turn, kind, text,
         coalesce(list_sort(list(struct_pack(turn := turn, role := role, text := text)) OVER (
            PARTITION BY conv_id, epoch ORDER BY turn ROWS BETWEEN {cap} PRECEDING AND 1 PRECEDING)),
            []) AS h
  FROM hm)
"""


HIST_SELECT = """
SELECT conv_id, turn, CAST(len(h) AS BIGINT) AS n_history,
       array_to_string(list_transform(h, lambda x: CAST(x.turn AS VARCHAR)), ',') AS history_turns
FROM hh WHERE kind = 'message'
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


NORM_SELECT = "SELECT conv_id, pos, role, content FROM msgs"

ORACLE: dict[str, str] = {
    # --- S: manifests ---
    "manifest_select": _with(MANIFEST) + "SELECT path FROM manifest WHERE starts_with(path, 'runs/src2/') AND suffix(path, '.jsonl')",
    "manifest_category": _with(MANIFEST) + """
        SELECT path, 'identity' AS category FROM manifest WHERE path = 'runs/src0/fr/0.jsonl'
        UNION ALL
        SELECT path, 'skills' AS category FROM manifest WHERE starts_with(path, 'runs/src4/') AND suffix(path, '.jsonl')""",
    "manifest_ext_counts": _with(MANIFEST) + """
        SELECT regexp_extract(path, '\\.([^./]+)$', 1) AS ext, count(*) AS n FROM manifest GROUP BY 1""",
    "manifest_ignore": _with(MANIFEST) + """
        SELECT path FROM (SELECT path, regexp_replace(path, '^runs/[^/]+/[^/]+/', '') AS rel FROM manifest)
        WHERE NOT (rel GLOB 'checkpoint-*' OR rel GLOB '*.pyc' OR rel GLOB 'runs/*' OR rel = 'optimizer.pt'
                   OR rel = 'scheduler.pt' OR rel = 'rng_state.pth' OR rel GLOB '*.tmp')""",
    "manifest_allow": _with(MANIFEST) + "SELECT path FROM manifest WHERE path GLOB 'runs/src2/*'",
    "manifest_reroot": _with(MANIFEST) + """
        SELECT path, substr(path, 11) AS new_path FROM manifest WHERE starts_with(path, 'runs/src2/')""",
    "manifest_conflicts": _with(MANIFEST) + """
        SELECT new_path, count(*) AS n FROM (
          SELECT CASE WHEN starts_with(path, 'runs/src2/') THEN substr(path, 11) ELSE path END AS new_path,
                 CASE WHEN starts_with(path, 'runs/src2/') THEN 1 ELSE 0 END AS moved FROM manifest)
        GROUP BY new_path HAVING count(*) > 1 AND max(moved) = 1""",
    # --- S: scans and sinks ---
    "manifest_list_files": """
        SELECT 'convs=' || CAST(conv_id // 64 AS VARCHAR) AS folder,
               CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS BIGINT) AS length, true AS timed
        FROM conversations GROUP BY conv_id // 64
        UNION ALL SELECT 'empty', 0, true UNION ALL SELECT '_hidden', 0, true""",
    "jsonl_scan": _with(LINES) + "SELECT file, conv_id FROM lines",
    "jsonl_rejects": _with(LINES) + "SELECT file, conv_id FROM lines WHERE outcome = 'json_error'",
    "normalize_reject_lines": _with(LINES) + """
        SELECT file, line_no, outcome FROM (
          SELECT file, outcome, row_number() OVER (PARTITION BY file ORDER BY conv_id) AS line_no FROM lines)
        WHERE outcome <> 'ok'""",
    "train_coverage_guard": _with(LINES, COVERAGE) + """
        SELECT n_key, n_total, pct, CASE WHEN pct < 5.0 THEN 'warn' ELSE 'ok' END AS verdict FROM cov2""",
    "train_sink": _with(LINES) + "SELECT CAST(n_messages AS BIGINT) AS n_messages, count(*) AS n_rows FROM prep_rows GROUP BY 1",
    "train_reload": _with(LINES) + """
        SELECT m.role, count(*) AS n FROM prep_rows p JOIN msgs m ON m.conv_id = p.conv_id GROUP BY m.role""",
    "marker_roundtrip": _with(RENDER) + f"""
        SELECT conv_id, CAST(generate_subscripts(tl, 1) - 1 AS BIGINT) AS pos, unnest(tl) AS token FROM (
          SELECT conv_id, x[greatest(len(x) - 3, 0) + 1 : len(x)] AS tl FROM (
            SELECT conv_id, regexp_extract_all(split_part(text, first_response, 1), '{PAT}') AS x FROM rend))""",
    # --- P: normalisation ---
    "normalize_rows": _with(LINES) + NORM_SELECT,
    "norm_messages": _with(LINES) + NORM_SELECT + " WHERE shape = 'messages'",
    "norm_conversation": _with(LINES) + NORM_SELECT + " WHERE shape = 'conversation'",
    "norm_instruction": _with(LINES) + NORM_SELECT + " WHERE shape = 'instruction'",
    "normalize_messages_only": _with(LINES) + """
        SELECT conv_id, CASE WHEN outcome = 'json_error' THEN 'json_error'
                             WHEN shape <> 'messages' THEN 'unknown_shape' ELSE outcome END AS outcome FROM lines""",
    "normalize_rejects": _with(LINES) + "SELECT conv_id, outcome FROM lines WHERE outcome <> 'ok'",
    "normalize_outcome_counts": _with(LINES) + "SELECT file, outcome, count(*) AS n FROM lines GROUP BY file, outcome",
    "role_alias": "SELECT conv_id, turn, role FROM conversations",
    "strip_ws": "SELECT conv_id, turn, text FROM conversations",
    # --- K: keywords ---
    "keyword_flag": _with(CONV_FLAG) + "SELECT conv_id, flag FROM cflag",
    "keyword_flag_ci": """
        SELECT conv_id, contains(lower(string_agg(text, ' ' ORDER BY turn)), 'ung') AS flag
        FROM conversations GROUP BY conv_id""",
    # --- J/U/O/A/G/L ---
    "file_multiplier": _with(LINES) + "SELECT DISTINCT file, CAST(mult AS BIGINT) AS mult FROM lines",
    "category_multiplier": _with(LINES) + """
        SELECT DISTINCT file, CASE WHEN file = 'team_identity.jsonl' THEN 'identity' ELSE 'skills' END AS category,
               CAST(mult AS BIGINT) AS mult FROM lines""",
    "union_files": _with(LINES) + "SELECT file, conv_id, CAST(n_messages AS BIGINT) AS n_messages FROM prep",
    "oversample": _with(LINES) + "SELECT conv_id, replica FROM prep_rows",
    "file_stats": _with(LINES) + """
        SELECT file, count(*) FILTER (WHERE outcome = 'ok') AS n_original,
               CAST(coalesce(sum(CASE WHEN outcome = 'ok' THEN mult ELSE 0 END), 0) AS BIGINT) AS n_final,
               count(*) FILTER (WHERE outcome NOT IN ('ok', 'json_error')) AS n_invalid,
               count(*) FILTER (WHERE outcome = 'json_error') AS n_json_error
        FROM lines GROUP BY file""",
    "keyword_coverage": _with(LINES, COVERAGE) + "SELECT n_key, n_total, pct FROM cov2",
    "coverage_soft_guard": _with(LINES, COVERAGE) + """
        SELECT pct, CASE WHEN pct < 10.0 THEN 'warn' ELSE 'ok' END AS verdict FROM cov2""",
    "coverage_band_guard": _with(LINES, COVERAGE) + """
        SELECT pct, CASE WHEN pct < 10.0 THEN 'raise' WHEN pct > 18.0 THEN 'lower' ELSE 'ok' END AS verdict FROM cov2""",
    "prep_summary": _with(LINES, COVERAGE) + """
        SELECT n_total AS n_rows, pct, CAST(n_total // 16 AS BIGINT) AS steps_per_epoch,
               CAST((2 * n_total) // 16 AS BIGINT) AS total_steps,
               CAST((2 * n_total) // 16 AS DOUBLE) / 0.15::DOUBLE / 60.0::DOUBLE AS est_minutes FROM cov2""",
    "step_plan": _with(CONV_FLAG, SPLIT_A.replace("sp AS", "spa AS"), """
        cntb AS (SELECT count(*) FILTER (WHERE flag) AS n_id, count(*) FILTER (WHERE NOT flag) AS n_other FROM cflag),
        qb AS (SELECT least(30, n_id // 2) AS k_id, least(270, n_other // 2) AS k_other FROM cntb),
        spb AS (SELECT ranked.*, CASE WHEN (flag AND rn <= qb.k_id) OR (NOT flag AND rn <= qb.k_other)
                                      THEN 'eval' ELSE 'train' END AS split FROM ranked, qb),
        nt AS (SELECT 'A' AS profile, count(*) FILTER (WHERE split = 'train') AS n_train, 16 AS b, 2 AS ep, 100 AS fl FROM spa
               UNION ALL
               SELECT 'B', count(*) FILTER (WHERE split = 'train'), 8, 1, 20 FROM spb),
        sp2 AS (SELECT profile, n_train, ep, fl, CAST(greatest(1, ceil(n_train::DOUBLE / b::DOUBLE)) AS BIGINT) AS spe FROM nt)
        """) + """
        SELECT profile, n_train, spe AS steps_per_epoch, spe * ep AS total_steps,
               CAST(greatest(fl, spe // 3) AS BIGINT) AS eval_every FROM sp2""",
    # --- O2 / X ---
    "seeded_shuffle": """
        SELECT conv_id, row_number() OVER (ORDER BY md5('42:' || CAST(conv_id AS VARCHAR)), conv_id) AS rank
        FROM (SELECT DISTINCT conv_id FROM conversations)""",
    "split_profile_a": _with(CONV_FLAG, SPLIT_A) + "SELECT conv_id, split FROM sp",
    "split_profile_b": _with(CONV_FLAG, SPLIT_B) + "SELECT conv_id, split FROM sp",
    "split_summary": _with(CONV_FLAG, SPLIT_A) + "SELECT split, flag, count(*) AS n FROM sp GROUP BY split, flag",
    "split_leak_safe": _with(LINES, "units AS (SELECT conv_id, flag FROM prep)",
                             _split_sql("units", "conv_id", "md5('42:' || CAST(conv_id AS VARCHAR)), conv_id",
                                        QA_ID, QA_OTHER)) + """
        SELECT p.conv_id, p.replica, sp.split FROM prep_rows p JOIN sp ON sp.conv_id = p.conv_id
        WHERE sp.split = 'train' OR p.replica = 1""",
    "split_leak_report": _with(LINES, _split_sql(
        "prep_rows", "conv_id, replica",
        "md5('42:' || CAST(conv_id AS VARCHAR) || ':' || CAST(replica AS VARCHAR)), conv_id, replica",
        QA_ID, QA_OTHER)) + """
        SELECT 'compat' AS mode, count(*) AS n_leaked FROM (
          SELECT conv_id FROM sp GROUP BY conv_id
          HAVING count(*) FILTER (WHERE split = 'eval') > 0 AND count(*) FILTER (WHERE split = 'train') > 0)
        UNION ALL SELECT 'leak_safe', CAST(0 AS BIGINT)""",
    # --- T ---
    "render_chat": _with(RENDER) + "SELECT conv_id, text FROM rend",
    "render_prompt": f"""
        SELECT a.conv_id, a.turn,
               coalesce(string_agg('<|im_start|>' || c.role || {NL} || c.text || '<|im_end|>' || {NL}, '' ORDER BY c.turn), '')
                 || '<|im_start|>assistant' || {NL} AS prompt
        FROM conversations a LEFT JOIN conversations c ON c.conv_id = a.conv_id AND c.turn < a.turn
        WHERE a.role = 'assistant' GROUP BY a.conv_id, a.turn""",
    "marker_check": _with(RENDER) + f"""
        SELECT count(*) AS n_rows,
               count(*) FILTER (WHERE NOT contains(text, '<|im_start|>assistant' || {NL})) AS n_missing FROM rend""",
    "tokenize_simple": _with(RENDER) + """
        SELECT conv_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens_text FROM toks""",
    "array_find_subseq": _with(RENDER) + """
        SELECT conv_id, CAST(first_pos AS BIGINT) AS pos, CAST(last_pos AS BIGINT) AS last_pos FROM pos""",
    "marker_tail": _with(RENDER) + f"""
        SELECT conv_id, array_to_string(x[greatest(len(x) - 3, 0) + 1 : len(x)], ' ') AS tail3,
               array_to_string(x[greatest(len(x) - 5, 0) + 1 : len(x)], ' ') AS tail5 FROM (
          SELECT conv_id, regexp_extract_all(split_part(text, first_response, 1), '{PAT}') AS x FROM rend)""",
    "completion_mask": _with(RENDER) + """
        SELECT conv_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(mask_start AS BIGINT) AS mask_start,
               CAST(CASE WHEN mask_start IS NULL THEN 0 ELSE len(t) - mask_start END AS BIGINT) AS n_trained FROM mask""",
    "marker_mismatch": _with(RENDER) + """
        SELECT k.conv_id, k.n_markers, a.n_assistant, k.n_markers <> a.n_assistant AS mismatch FROM (
          SELECT conv_id, CAST(len(list_filter(range(0, len(t) - 1),
                 lambda i: t[i + 1] = '<|im_start|>' AND t[i + 2] = 'assistant')) AS BIGINT) AS n_markers FROM toks) k
        JOIN (SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS n_assistant
              FROM conversations GROUP BY conv_id) a ON a.conv_id = k.conv_id""",
    "completion_mask_all": _with(RENDER) + f"""
        SELECT t.conv_id, CAST(len(t.t) AS BIGINT) AS n_tokens, coalesce(a.n, 0) AS n_trained
        FROM toks t LEFT JOIN (
          SELECT conv_id, CAST(sum(len(regexp_extract_all(text || '<|im_end|>', '{PAT}'))) AS BIGINT) AS n
          FROM conversations WHERE role = 'assistant' GROUP BY conv_id) a ON a.conv_id = t.conv_id""",
    "truncate_tokens": _with(RENDER) + """
        SELECT conv_id, CAST(least(len(t), 256) AS BIGINT) AS n_kept,
               CASE WHEN len(t) > 0 THEN t[least(len(t), 256)] END AS last_token FROM toks""",
    "truncation_report": _with(RENDER) + """
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE len(t) > 256) AS n_truncated,
               count(*) FILTER (WHERE mask_start IS NULL OR mask_start >= 256) AS n_response_cut FROM mask""",
    "strip_prompt": f"""
        WITH r AS (SELECT conv_id, turn, role, text,
                          '<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL} AS one FROM conversations),
             g AS (SELECT a.conv_id, a.turn, any_value(a.text) AS text,
                          coalesce(string_agg(b.one, '' ORDER BY b.turn), '') || '<|im_start|>assistant' || {NL} AS prompt
                   FROM r a LEFT JOIN r b ON a.conv_id = b.conv_id AND b.turn < a.turn
                   WHERE a.role = 'assistant' GROUP BY a.conv_id, a.turn),
             x AS (SELECT conv_id, turn, len(regexp_extract_all(prompt, '{PAT}')) AS n_prompt,
                          regexp_extract_all(prompt || text || '<|im_end|>' || {NL}, '{PAT}') AS whole FROM g)
        SELECT conv_id, turn, CAST(n_prompt AS BIGINT) AS n_prompt, CAST(len(whole) - n_prompt AS BIGINT) AS n_generated,
               array_to_string(whole[n_prompt + 1 : len(whole)], ' ') AS generated FROM x""",
    "subword_mask": """
        SELECT conv_id, coalesce(string_agg(text || '<|im_end|>', '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')
               AS trained_text, true AS whole FROM conversations GROUP BY conv_id""",
    "subword_mask_last": f"""
        WITH l AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS t FROM conversations GROUP BY conv_id)
        SELECT l.conv_id, coalesce(string_agg(CASE WHEN c.turn = l.t THEN text || '<|im_end|>' || {NL}
                 ELSE '<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL} END, '' ORDER BY turn)
                 FILTER (WHERE c.turn >= l.t), '') AS trained_text
        FROM l JOIN conversations c ON c.conv_id = l.conv_id GROUP BY l.conv_id""",
    "decode_tokens": f"""
        SELECT conv_id, turn, text AS decoded,
               CAST(octet_length(encode(text)) AS BIGINT) AS n_ids FROM conversations""",
    "marker_choice": _with(RENDER) + f"""
        SELECT conv_id, CASE WHEN first_pos >= 0 THEN '<|im_start|> assistant'
               ELSE array_to_string(x[greatest(len(x) - 5, 0) + 1 : len(x)], ' ') END AS marker FROM (
          SELECT r.conv_id, p.first_pos,
                 regexp_extract_all(split_part(r.text, r.first_response, 1), '{PAT}') AS x
          FROM rend r JOIN pos p ON p.conv_id = r.conv_id)""",
    "guarded_sink": _with(LINES, COVERAGE) + """
        SELECT pct BETWEEN 10.0 AND 18.0 AS written,
               CAST(CASE WHEN pct BETWEEN 10.0 AND 18.0 THEN n_total ELSE 0 END AS BIGINT) AS n_rows FROM cov2""",
    # --- E ---
    "response_pass": """
        SELECT conv_id, turn,
               (contains(text, 'the') OR contains(text, 'ung')) AND NOT contains(text, 'Ung') AS ok,
               substr(text, 1, 100) AS preview
        FROM conversations WHERE role = 'assistant'""",
    "response_pass_by_step": """
        SELECT turn AS step,
               count(*) FILTER (WHERE (contains(text, 'the') OR contains(text, 'ung')) AND NOT contains(text, 'Ung')) AS n_pass,
               count(*) AS n
        FROM conversations WHERE role = 'assistant' AND turn > 0 AND turn % 2 = 0 GROUP BY turn""",
    # --- M ---
    "run_heartbeat": _with(RUNLOG) + """
        SELECT run_id, step, rate, (max_steps - step)::DOUBLE / greatest(rate, 0.001::DOUBLE) AS eta FROM (
          SELECT run_id, step, max_steps, step::DOUBLE / greatest(elapsed, 1.0::DOUBLE) AS rate FROM rl
          WHERE step > 0 AND step % 20 = 0)""",
    "run_peaks": _with(RUNLOG) + """
        SELECT run_id, CAST(ceil(step / 20) AS BIGINT) AS bucket, max(eval_loss) AS peak,
               arg_max_null(eval_loss, step) AS last_value
        FROM rl GROUP BY run_id, CAST(ceil(step / 20) AS BIGINT)""",
    "latest_checkpoint": _with(RUNLOG) + "SELECT run_id, arg_max(path, step) AS path FROM ck GROUP BY run_id",
    "best_checkpoint": _with(RUNLOG) + """
        SELECT run_id, arg_min(path, (eval_loss, step)) AS path, arg_min(eval_loss, (eval_loss, step)) AS eval_loss
        FROM ck WHERE eval_loss IS NOT NULL GROUP BY run_id""",
    "retain_checkpoints": _with(RUNLOG) + """
        SELECT run_id, path FROM (
          SELECT run_id, path, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS rn FROM ck) WHERE rn <= 2
        UNION
        SELECT run_id, arg_min(path, (eval_loss, step)) FROM ck WHERE eval_loss IS NOT NULL GROUP BY run_id""",
    # --- H ---
    "session_commands": _with(SESSION) + "SELECT conv_id, turn, kind FROM kd",
    "session_epochs": _with(SESSION) + "SELECT conv_id, turn, kind, epoch FROM ep",
    "session_history": _with(SESSION, _history(20)) + HIST_SELECT,
    "session_history_cap3": _with(SESSION, _history(3)) + HIST_SELECT,
    "session_history_count": _with(SESSION) + """
        SELECT conv_id, turn, CAST(least(20, coalesce(n, 0)) AS BIGINT) AS n_history FROM (
          SELECT conv_id, turn, kind,
                 sum(CASE WHEN kind IN ('message', 'response') THEN 1 ELSE 0 END) OVER (
                   PARTITION BY conv_id, epoch ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n
          FROM ep) WHERE kind = 'history'""",
    "session_prompt": _with(SESSION, _history(20)) + f"""
        SELECT conv_id, turn,
               '<|im_start|>system' || {NL} || 'You are a helpful assistant.' || '<|im_end|>' || {NL}
               || array_to_string(list_transform(h, lambda x: '<|im_start|>' || x.role || {NL} || x.text || '<|im_end|>' || {NL}), '')
               || '<|im_start|>user' || {NL} || text || '<|im_end|>' || {NL} || '<|im_start|>assistant' || {NL} AS prompt
        FROM hh WHERE kind = 'message'""",
    "join_chunks": "SELECT conv_id, turn, text FROM conversations",
    # --- W ---
    "stream_session": _with(SESSION, _history(20)) + HIST_SELECT,
    "stream_session_table": _with(SESSION, _history(20)) + HIST_SELECT,
    "stream_normalize": _with(LINES) + NORM_SELECT,
}
