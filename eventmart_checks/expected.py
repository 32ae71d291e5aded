"""Shared parts of the expected-result SQL (DuckDB), written independently of the Spark code.

Typed values come straight from the id arithmetic instead of from JSON, duplicates from a
minimum over text keys, flags from sums.
"""

from __future__ import annotations

PARTS = {
    # The event feed before copies: one row per event.
    "e": """
        SELECT event_id AS id, user_id AS uid, c_nationkey AS nk, ts,
               CASE WHEN event_id % 269 = 0 THEN 'assistant_hovered'
                    WHEN event_id % 271 = 0 THEN NULL
                    WHEN event_type = 'error' AND user_id % 50 = 0 THEN 'error_raised'
                    ELSE ['user_invited', 'user_signed_up',
                          'session_started', 'session_started', 'session_started',
                          'prompt_submitted', 'prompt_submitted', 'prompt_submitted',
                          'prompt_submitted', 'ai_response_generated', 'ai_response_generated',
                          'ai_response_generated', 'ai_response_generated',
                          'ai_response_generated', 'response_accepted', 'response_accepted',
                          'response_rejected', 'workflow_completed', 'workflow_completed',
                          'error_raised'][event_id % 20 + 1] END AS event_name,
               'events_' || strftime(ts, '%Y-%m-%d') || '.jsonl' AS source_file
        FROM events JOIN customer ON user_id = c_custkey""",
    # Typed columns of every event.
    "t": """
        SELECT *, event_name IS NOT DISTINCT FROM 'ai_response_generated' AS ai,
               CASE WHEN id % 211 = 0 THEN NULL WHEN id % 223 = 0 THEN ''
                    ELSE 'evt_' || id END AS event_id,
               CASE WHEN id % 227 <> 0 THEN date_trunc('second', ts) END AS event_ts,
               CASE WHEN id % 229 = 0 THEN NULL
                    ELSE date_trunc('second', ts) + to_seconds(CASE WHEN id % 37 = 0
                         THEN 7200 + id % 1000 ELSE id % 120 END) END AS received_ts,
               CASE WHEN id % 233 = 0 THEN NULL WHEN id % 239 = 0 THEN 'acct_999'
                    WHEN id % 241 = 0 THEN 'acct_' || lpad(((nk + 1) % 25)::VARCHAR, 3, '0')
                    ELSE 'acct_' || lpad(nk::VARCHAR, 3, '0') END AS account_id,
               CASE WHEN id % 251 = 0 THEN NULL WHEN id % 257 = 0 THEN 'user_x'
                    ELSE 'user_' || uid END AS user_id,
               CASE WHEN id % 263 = 0 OR event_name IN ('user_invited', 'user_signed_up')
                    THEN NULL
                    ELSE 'sess_' || uid || '_'
                         || (date_diff('day', DATE '2024-01-01', ts::DATE) // 6)
               END AS session_id
        FROM e""",
    # Typed properties of every event.
    "p": """
        SELECT *,
               CASE WHEN event_name IN ('ai_response_generated', 'prompt_submitted',
                    'workflow_completed', 'session_started', 'response_rejected',
                    'response_accepted') THEN 'wf_' || (uid % 4) END AS workflow,
               CASE WHEN ai THEN 'm' || (id % 3) END AS model,
               CASE WHEN ai THEN 50 + id % 900 END::INTEGER AS prompt_tokens,
               CASE WHEN ai THEN 10 + id % 300 END::INTEGER AS completion_tokens,
               CASE WHEN NOT ai OR id % 277 = 0 THEN NULL WHEN id % 281 = 0 THEN -5
                    ELSE 200 + (id * 37) % 4800 END::INTEGER AS latency_ms,
               CASE WHEN ai AND id % 7 <> 0 AND id % 11 <> 0
                    THEN (10001 + 10 * ((id * 13) % 1000)) / 100000 END::DOUBLE AS cost_usd,
               CASE WHEN ai AND id % 8 <> 1 THEN id % 3 <> 0 END AS accepted,
               CASE WHEN event_name = 'workflow_completed' THEN 1000 + id % 100000
               END::INTEGER AS duration_ms,
               CASE WHEN event_name = 'prompt_submitted' THEN id % 500
               END::INTEGER AS prompt_length_chars,
               CASE WHEN event_name = 'session_started' THEN 'web' END AS device,
               CASE WHEN event_name = 'error_raised' THEN 'E' || (id % 5) END AS error_code,
               CASE WHEN event_name = 'response_rejected' THEN 'tone' END AS rejected_reason_text,
               CASE WHEN event_name IN ('user_invited', 'user_signed_up') THEN 'email'
               END AS invite_channel,
               ai AND id % 277 = 0 AS breaks_contract
        FROM t""",
    # The feed: every event, exact copies (1) and early invalid copies (2).
    "f": """
        SELECT *, 0 AS copy, 4 * id + 1 AS line_number FROM p
        UNION ALL SELECT *, 1, 4 * id + 2 FROM p WHERE id % 31 = 0
        UNION ALL SELECT * REPLACE (NULL AS account_id, TIMESTAMP '2023-12-31' AS received_ts),
                         2, 4 * id + 3 FROM p WHERE id % 293 = 0""",
    # The feed as JSON lines.
    "j": """
        SELECT *, '{' || array_to_string(list_filter([
                 '"event_id":"' || event_id || '"',
                 '"event_ts":"' || event_ts_raw || '"',
                 '"received_ts":"' || strftime(received_ts, '%Y-%m-%dT%H:%M:%SZ') || '"',
                 '"account_id":"' || account_id || '"', '"user_id":"' || user_id || '"',
                 '"session_id":"' || session_id || '"', '"event_name":"' || event_name || '"',
                 '"properties":' || properties], lambda x: x IS NOT NULL), ',') || '}' AS line
        FROM (SELECT *,
                coalesce(strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ'), '2024-01-01 99:99:99')
                  AS event_ts_raw,
                CASE event_name
                  WHEN 'ai_response_generated' THEN '{"workflow":"' || workflow || '","model":"'
                    || model || '","prompt_tokens":' || prompt_tokens || ',"completion_tokens":'
                    || completion_tokens || ',"latency_ms":'
                    || coalesce(latency_ms::VARCHAR, '"fast"')
                    || CASE WHEN id % 7 = 0 THEN '' WHEN id % 11 = 0 THEN ',"cost_usd":null'
                       ELSE ',"cost_usd":0.1' || lpad(((id * 13) % 1000)::VARCHAR, 3, '0') || '1'
                       END
                    || coalesce(',"accepted":' || accepted::VARCHAR, '') || '}'
                  WHEN 'prompt_submitted' THEN '{"workflow":"' || workflow
                    || '","prompt_length_chars":' || prompt_length_chars || '}'
                  WHEN 'workflow_completed' THEN '{"workflow":"' || workflow
                    || '","duration_ms":' || duration_ms || '}'
                  WHEN 'session_started' THEN '{"workflow":"' || workflow || '","device":"web"}'
                  WHEN 'error_raised' THEN '{"error_code":"' || error_code || '"}'
                  WHEN 'response_rejected' THEN '{"workflow":"' || workflow || '","reason":"tone"}'
                  WHEN 'response_accepted' THEN '{"workflow":"' || workflow || '"}'
                  WHEN 'user_invited' THEN '{"invite_channel":"email"}'
                  WHEN 'user_signed_up' THEN '{"invite_channel":"email"}' END AS properties
              FROM f)""",
    # Lines that are no event object.
    "bad": """
        SELECT id, source_file, 4 * id + 4 AS line_number,
               CASE WHEN id % 307 = 0 THEN '{not json ' || (id + 1)
                    WHEN id % 311 = 0 THEN '[' || id || ']'
                    WHEN id % 313 = 0 THEN '"' || id || '"'
                    WHEN id % 317 = 0 THEN id::VARCHAR
                    WHEN id % 331 = 0 THEN id || '.5'
                    WHEN id % 337 = 0 THEN 'true'
                    WHEN id % 347 = 0 THEN 'null'
                    WHEN id % 349 = 0 THEN '{"a":' || id || '} x'
                    WHEN id % 353 = 0 THEN '{"a":' || id || '},{"b":1}' END AS line,
               CASE WHEN id % 307 = 0 THEN 'malformed_json'
                    WHEN id % 311 = 0 THEN 'not_a_json_object: got list'
                    WHEN id % 313 = 0 THEN 'not_a_json_object: got str'
                    WHEN id % 317 = 0 THEN 'not_a_json_object: got int'
                    WHEN id % 331 = 0 THEN 'not_a_json_object: got float'
                    WHEN id % 337 = 0 THEN 'not_a_json_object: got bool'
                    WHEN id % 347 = 0 THEN 'not_a_json_object: got NoneType'
                    WHEN id % 349 = 0 OR id % 353 = 0 THEN 'malformed_json' END AS reason
        FROM e WHERE reason IS NOT NULL""",
    # Every physical line of the generated files with its place, blank lines left out.
    "placed": """
        SELECT file, line, id, row_number() OVER w + coalesce(sum((id % 13 = 0)::INT) OVER (
                 w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
        FROM (SELECT id // 5000 AS file, id, line_number, line FROM j
              UNION ALL SELECT id // 5000, id, line_number, line FROM bad)
        WINDOW w AS (PARTITION BY file ORDER BY line_number)""",
    "accounts": """
        SELECT 'acct_' || lpad(n_nationkey::VARCHAR, 3, '0') AS account_id,
               n_name AS account_name,
               CASE n_nationkey % 3 WHEN 0 THEN 'enterprise' WHEN 1 THEN 'growth'
                    ELSE 'starter' END AS plan,
               (SELECT r_name FROM region WHERE r_regionkey = n_regionkey) AS industry,
               (10 + 5 * n_nationkey)::INTEGER AS seat_limit,
               TIMESTAMP '2023-06-01' AS created_at
        FROM nation""",
    "users": """
        SELECT 'user_' || c_custkey AS user_id,
               'acct_' || lpad(c_nationkey::VARCHAR, 3, '0') AS account_id,
               'u' || c_custkey || '@n' || c_nationkey || '.example' AS email,
               c_mktsegment AS role, 'active' AS status, TIMESTAMP '2023-06-01' AS created_at
        FROM customer""",
    "names": """
        SELECT unnest(['user_invited', 'user_signed_up', 'session_started', 'prompt_submitted',
                       'ai_response_generated', 'response_accepted', 'response_rejected',
                       'workflow_completed', 'error_raised']) AS event_name""",
    # The first broken rule, as the smallest rule number.
    "v": """
        SELECT f.*, u.account_id AS user_home_account_id, list_min(list_filter([
                 CASE WHEN coalesce(event_id, '') = '' THEN 1 END,
                 CASE WHEN event_ts IS NULL THEN 2 END,
                 CASE WHEN n.event_name IS NULL THEN 3 END,
                 CASE WHEN f.account_id IS NULL THEN 4 END,
                 CASE WHEN f.user_id IS NULL THEN 5 END,
                 CASE WHEN session_id IS NULL AND f.event_name NOT LIKE 'user%' THEN 6 END,
                 CASE WHEN breaks_contract THEN 7 END,
                 CASE WHEN latency_ms < 0 THEN 8 END,
                 CASE WHEN a.account_id IS NULL THEN 9 END,
                 CASE WHEN u.user_id IS NULL THEN 10 END,
                 CASE WHEN u.account_id <> f.account_id THEN 11 END],
                 lambda x: x IS NOT NULL)) AS rule
        FROM f LEFT JOIN names n ON n.event_name = f.event_name
        LEFT JOIN accounts a ON a.account_id = f.account_id
        LEFT JOIN users u ON u.user_id = f.user_id""",
    "earliest_copy": """
        SELECT event_id, min(coalesce(received_ts::VARCHAR, 'never') || ' ' || source_file || ' '
               || lpad(line_number::VARCHAR, 12, '0')) AS earliest
        FROM v WHERE rule IS NULL GROUP BY event_id""",
    # Classified events.
    "c": """
        SELECT v.* EXCLUDE (rule), CASE WHEN rule IS NULL AND right(earliest, 12)::BIGINT
                 <> line_number THEN 'duplicate_event_id'
               ELSE ['missing_event_id', 'unparseable_event_ts', 'unknown_event_name',
                     'missing_account_id', 'missing_user_id', 'missing_session_id',
                     'invalid_property_type', 'negative_metric_value', 'unknown_account',
                     'unknown_user', 'user_account_mismatch'][rule] END AS rejection_reason
        FROM v LEFT JOIN earliest_copy k ON k.event_id = v.event_id""",
    # Clean events.
    "s": """
        SELECT *, event_ts::DATE AS event_date,
               epoch(received_ts)::BIGINT - epoch(event_ts)::BIGINT AS lateness_seconds,
               prompt_tokens + completion_tokens AS total_tokens
        FROM c WHERE rejection_reason IS NULL""",
    "rejected": """
        SELECT 'ingest' AS rejection_stage, reason AS rejection_reason, NULL AS event_id,
               NULL AS event_name, line AS raw_data, source_file, line_number FROM bad
        UNION ALL
        SELECT 'staging', rejection_reason, c.event_id, c.event_name, j.line, c.source_file,
               c.line_number
        FROM c JOIN j USING (id, copy) WHERE rejection_reason IS NOT NULL""",
    "rates": """
        SELECT model, sum(cost_usd::DECIMAL(18, 6))::DOUBLE / sum(total_tokens) AS usd_per_token
        FROM s WHERE ai AND cost_usd IS NOT NULL GROUP BY model""",
    # AI calls.
    "i": """
        SELECT s.*, usd_per_token,
               coalesce(cost_usd, round(usd_per_token * total_tokens, 6)) AS cost_usd_estimated
        FROM s JOIN rates USING (model) WHERE ai""",
    # Sessions.
    "q": """
        SELECT session_id,
               first(account_id ORDER BY event_ts, event_id) AS account_id,
               first(user_id ORDER BY event_ts, event_id) AS user_id,
               first(event_id ORDER BY event_ts, event_id) AS first_event_id,
               min(event_ts) AS started_at, max(event_ts) AS ended_at, max(workflow) AS workflow,
               count(*) AS event_count,
               sum((event_name = 'session_started')::INT)::BIGINT AS n1,
               sum((event_name = 'prompt_submitted')::INT)::BIGINT AS n2,
               sum((event_name = 'ai_response_generated')::INT)::BIGINT AS n3,
               sum((event_name = 'response_accepted')::INT)::BIGINT AS n4,
               sum((event_name = 'response_rejected')::INT)::BIGINT AS n6,
               sum((event_name = 'workflow_completed')::INT)::BIGINT AS n5,
               sum((event_name = 'error_raised')::INT)::BIGINT AS n7,
               sum(total_tokens)::BIGINT AS total_tokens, sum(cost_usd::DECIMAL(18, 6))::DOUBLE AS cost_usd,
               date_diff('second', min(event_ts), max(event_ts)) AS duration_seconds
        FROM s WHERE session_id IS NOT NULL GROUP BY session_id""",
    # Accounts per day.
    "d": """
        SELECT s.event_date, s.account_id, account_name, plan,
               count(DISTINCT user_id) AS active_users, count(DISTINCT session_id) AS sessions,
               count(*) AS events,
               sum((event_name = 'prompt_submitted')::INT)::BIGINT AS prompts_submitted,
               sum(ai::INT)::BIGINT AS ai_interactions,
               sum((event_name = 'response_accepted')::INT)::BIGINT AS responses_accepted,
               sum((event_name = 'response_rejected')::INT)::BIGINT AS responses_rejected,
               sum((event_name = 'workflow_completed')::INT)::BIGINT AS workflows_completed,
               sum((event_name = 'error_raised')::INT)::BIGINT AS errors_raised,
               sum(CASE WHEN ai THEN total_tokens END)::BIGINT AS ai_total_tokens,
               coalesce(sum(cost_usd::DECIMAL(18, 6)), 0)::DOUBLE AS ai_cost_usd,
               sum((ai AND cost_usd IS NULL)::INT)::BIGINT AS uncosted_interactions,
               coalesce(any_value(est), 0)::DOUBLE AS ai_cost_usd_estimated
        FROM s JOIN accounts USING (account_id)
        LEFT JOIN (SELECT event_date, account_id, sum(cost_usd_estimated::DECIMAL(18, 6)) AS est
                   FROM i GROUP BY ALL) x
          ON x.event_date = s.event_date AND x.account_id = s.account_id
        GROUP BY s.event_date, s.account_id, account_name, plan""",
    "stages": """
        SELECT k::INTEGER AS stage_order,
               ['session_started', 'prompt_submitted', 'ai_response_generated',
                'response_accepted', 'workflow_completed'][k] AS stage,
               (SELECT count(*) FROM q WHERE n1 > 0 AND (k < 2 OR n2 > 0) AND (k < 3 OR n3 > 0)
                  AND (k < 4 OR n4 > 0) AND (k < 5 OR n5 > 0)) AS sessions
        FROM range(1, 6) r(k)""",
    "user_rates": """
        SELECT user_id, account_id, count(*) AS events,
               sum((event_name = 'error_raised')::INT)::BIGINT AS errors,
               errors / events AS rate
        FROM s GROUP BY ALL HAVING events >= 10""",
    "latency": """
        SELECT model, count(*) AS interactions,
               round(quantile_cont(latency_ms, 0.5)) AS median_latency_ms,
               round(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms
        FROM i GROUP BY model""",
}


PRELUDE = "WITH " + ", ".join(f"{name} AS ({part})" for name, part in PARTS.items())


def sql(query: str) -> str:
    """A query over the parts; those it does not need are never run."""
    return f"{PRELUDE} {query}"
