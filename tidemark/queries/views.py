"""SQL views that match ``tidemark.sources.tables``, for the checking engine."""

CORPUS = """corpus AS (
  SELECT CAST(substr(source, 4) AS INT) AS shard, doc_id, text, lang, source FROM documents)"""

RAW_RESULTS = """raw_results AS (
  SELECT user_id AS tag, ts, event_id, substr(md5(CAST(event_id AS VARCHAR)), 1, 7) AS commit,
    CASE WHEN event_type = 'error' THEN '0.000000' WHEN props LIKE '%7}' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS val_text,
    CASE WHEN event_type = 'error' THEN '0.0' ELSE regexp_extract(props, '([0-9]+)', 1) END AS mem_text,
    CASE event_type WHEN 'purchase' THEN ' keep' WHEN 'signup' THEN 'KEEP' || chr(9) WHEN 'view' THEN 'Discard '
      WHEN 'click' THEN 'discard' ELSE 'crash' END AS status_text,
    '  ' || event_type || ' at setting ' || props || ' gives ' || CAST(value AS VARCHAR) || ' ' AS description
  FROM events)"""

EXPERIMENTS = RAW_RESULTS + """,
experiments AS (
  SELECT tag, ts, event_id, commit, description,
    row_number() OVER (PARTITION BY tag ORDER BY ts, event_id) - 1 AS idx,
    TRY_CAST(val_text AS DOUBLE) AS val_bpb, TRY_CAST(mem_text AS DOUBLE) AS memory_gb,
    upper(trim(status_text, ' ' || chr(9))) AS status
  FROM raw_results)"""

STEP_LOG = """step_log AS (
  SELECT * FROM (
    SELECT user_id AS run_id, row_number() OVER w - 1 AS step, value AS loss,
      epoch_us(lead(ts) OVER w) - epoch_us(ts) AS dt_us
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
  WHERE dt_us IS NOT NULL)"""

JOB_STATES = """job_states AS (
  SELECT 'job-' || CAST(user_id AS VARCHAR) AS slug, epoch_us(ts) AS at_us, event_id,
    CASE WHEN props LIKE '%3}' THEN '' WHEN event_type = 'signup' THEN 'queued'
      WHEN event_type IN ('view', 'click') THEN 'running' WHEN event_type = 'purchase' THEN 'succeeded'
      ELSE 'failed' END AS state
  FROM events)"""


FROM_VALUE = """from_value AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS "from", text AS value
  FROM conversations)"""

UNEVEN = FROM_VALUE + """,
uneven AS (
  SELECT conv_id, turn, CASE WHEN conv_id % 7 = 3 AND turn = 1 THEN NULL WHEN conv_id % 4 = 1 AND turn = 1 THEN 'system'
      ELSE "from" END AS "from",
    CASE WHEN conv_id % 3 = 1 AND turn % 4 = 3 THEN ' ' || chr(10) || chr(9) || chr(160) || ' ' ELSE value END AS value
  FROM from_value),
messages AS (
  SELECT conv_id, turn, CASE "from" WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'model' END AS role, value AS text FROM uneven
  WHERE "from" IN ('human', 'gpt') AND trim(value, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) <> ''),
facts AS (
  SELECT c.conv_id, coalesce(n, 0) AS n_messages, coalesce(letters, '') AS letters, malformed,
    NOT malformed AND coalesce(regexp_matches(letters, '^(um)+u?$'), false) AS valid
  FROM (SELECT conv_id, bool_or("from" IS NULL) AS malformed FROM uneven GROUP BY conv_id) c
  LEFT JOIN (SELECT conv_id, count(*) AS n, string_agg(left(role, 1), '' ORDER BY turn) AS letters FROM messages GROUP BY conv_id) m
    ON c.conv_id = m.conv_id),
segments AS (
  SELECT m.conv_id, turn, role, text, '<|turn>' || role || chr(10) AS opener, '<|turn>' || role || chr(10) || text || '<turn|>' || chr(10) AS segment
  FROM messages m JOIN facts f ON m.conv_id = f.conv_id WHERE valid)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


RUN_FACTS = STEP_LOG + """,
runs AS (SELECT run_id, count(*) AS steps, min(loss) AS best, coalesce(sum(dt_us) FILTER (step > 10), 0) AS timed_us,
  sum(dt_us) AS all_us FROM step_log GROUP BY run_id),
summary AS (
  SELECT run_id, 3 AS line_no, 'val_bpb' AS key, best AS value, printf('%.6f', best) AS shown FROM runs
  UNION ALL SELECT run_id, 4, 'training_seconds', (timed_us // 100000) / 10, (timed_us // 1000000) || '.' || (timed_us // 100000) % 10 FROM runs
  UNION ALL SELECT run_id, 5, 'total_seconds', (all_us // 100000) / 10, (all_us // 1000000) || '.' || (all_us // 100000) % 10 FROM runs
  UNION ALL SELECT run_id, 6, 'peak_vram_mb', steps * 100 + 0.5, (steps * 100) || '.5' FROM runs
  UNION ALL SELECT run_id, 7, 'num_steps', steps, steps || '' FROM runs
  UNION ALL SELECT run_id, 8, 'depth', 8, '8' FROM runs),
log_lines AS (
  SELECT run_id, line_no, rpad(key || ':', 18, ' ') || shown AS line FROM summary
  UNION ALL SELECT run_id, 0, 'starting run ' || run_id FROM runs
  UNION ALL SELECT run_id, 1, 'val_bpb is computed at the end' FROM runs
  UNION ALL SELECT run_id, 2, '---' FROM runs UNION ALL SELECT run_id, 9, 'finished' FROM runs)"""

STAGES = """stage_events AS (
  SELECT user_id AS run_id, event_type AS stage, epoch_us(ts) AS at_us,
    CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 2 = 1 THEN 'start' ELSE 'end' END AS edge FROM events),
stages AS (SELECT run_id, stage, round((max(at_us) FILTER (edge = 'end') - min(at_us) FILTER (edge = 'start')) / 1e6, 2) AS seconds
  FROM stage_events GROUP BY run_id, stage)"""
