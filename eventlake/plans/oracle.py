"""DuckDB statements that give the same rows as the registered queries, written independently.

Each statement lists the shared views it needs; they are put in front as common table expressions.
"""

from __future__ import annotations

_VIEWS = {
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "usage": """
        SELECT event_id AS seq,
          CASE WHEN k = 99 THEN NULL ELSE 'evt-' || event_id END AS event_id,
          'usage' AS event_type, CAST(user_id AS varchar) AS user_id, 'user' || (user_id % 15) AS username,
          CASE WHEN k = 98 THEN '' ELSE CASE k % 5 WHEN 0 THEN 'api-gateway' WHEN 1 THEN 'billing'
            WHEN 2 THEN 'search' WHEN 3 THEN 'recommendation' ELSE 'storage' END END AS service,
          CASE user_id % 5 WHEN 0 THEN 'request' WHEN 1 THEN 'read' WHEN 2 THEN 'write' WHEN 3 THEN 'upload'
            ELSE 'download' END AS usage_type,
          CAST(floor(value) AS int) AS quantity,
          strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp", k, ts
        FROM ev""",
    "parsed": """
        SELECT event_id, event_type, user_id, username, service, usage_type,
          CASE WHEN k = 96 THEN NULL ELSE quantity END AS quantity, "timestamp"
        FROM usage WHERE event_id IS NOT NULL AND k <> 97""",
    "security": """
        SELECT event_id AS seq, CAST(event_id AS varchar) AS event_id,
          epoch_us(ts - to_hours(k % 7)) AS ets_us,
          CASE WHEN event_type = 'error' THEN 'LOGIN_FAILED' ELSE upper(event_type) END AS event_type,
          CASE WHEN k % 20 = 0 THEN NULL WHEN k % 20 = 1 THEN '' ELSE 'user' || (user_id % 15) END AS username,
          CASE WHEN k % 4 = 0 THEN NULL ELSE '10.10.' || (user_id % 256) || '.' || k END AS ip_address,
          'usage-api' AS client_id, 'main' AS realm, k
        FROM ev""",
    "failed": """
        SELECT * FROM security WHERE event_type = 'LOGIN_FAILED' AND username IS NOT NULL AND username <> ''""",
    "incidents": """
        SELECT seq, username, rn - coalesce(gone, 0) AS failed_attempts, 259200 AS window_seconds, ip_address,
          client_id, realm
        FROM (SELECT *, count(*) OVER (PARTITION BY username ORDER BY mx
                RANGE BETWEEN UNBOUNDED PRECEDING AND 259200000001 PRECEDING) AS gone
              FROM (SELECT *, row_number() OVER (PARTITION BY username ORDER BY seq) AS rn,
                      max(ets_us) OVER (PARTITION BY username ORDER BY seq ROWS UNBOUNDED PRECEDING) AS mx
                    FROM failed))
        WHERE rn - coalesce(gone, 0) >= 5""",
    "risks": """
        SELECT *, CASE WHEN risk_score >= 80 THEN 'HIGH' WHEN risk_score >= 50 THEN 'MEDIUM' ELSE 'LOW' END
          AS risk_level
        FROM (SELECT *, least(100, CASE WHEN failed_attempts >= 20 THEN 70 WHEN failed_attempts >= 10 THEN 50
                ELSE 30 END + CASE WHEN ip_address <> '' THEN 10 ELSE 0 END) AS risk_score FROM incidents)""",
    "decisions": """
        SELECT *, CASE risk_level WHEN 'HIGH' THEN 'DISABLE_USER' WHEN 'MEDIUM' THEN 'ALERT' ELSE 'LOG' END
          AS action, CASE risk_level WHEN 'HIGH' THEN 'High risk brute force'
          WHEN 'MEDIUM' THEN 'Medium risk brute force' ELSE 'Low risk suspicious activity' END AS reason
        FROM risks""",
    "steps": "SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS step",
    "messages": """
        SELECT e.event_id * 10 + step AS arrival, 'evt-' || e.event_id AS event_id,
          CASE WHEN step = 1 THEN 'kafka' WHEN step IN (2, 3, 6) THEN 'spark' WHEN step IN (4, 5) THEN 'iceberg'
            ELSE 'minio' END AS stage,
          CASE step WHEN 1 THEN CASE WHEN k % 50 = 0 THEN 'failed' ELSE 'completed' END
            WHEN 2 THEN 'processing' WHEN 3 THEN 'completed' WHEN 4 THEN 'processing'
            WHEN 5 THEN CASE WHEN k % 10 = 0 THEN 'failed' ELSE 'completed' END
            WHEN 6 THEN 'failed' WHEN 7 THEN 'processing'
            WHEN 8 THEN CASE WHEN k % 17 = 0 THEN 'failed' ELSE 'completed' END ELSE '' END AS status,
          CASE WHEN step BETWEEN 3 AND 8 THEN CAST(e.event_id // 100 AS varchar) END AS batch_id,
          step = 5 AND k % 10 <> 0 AS has_snapshot,
          CASE WHEN step = 5 AND k % 10 <> 0 AND k % 4 <> 0 THEN CAST(1000 + e.event_id // 100 AS varchar) END
            AS snapshot_id,
          CASE WHEN step = 1 THEN CASE WHEN user_id % 7 = 0 THEN 'usage-replay' ELSE 'usage-events' END END
            AS topic,
          CASE WHEN step = 1 THEN CAST(user_id % 3 AS varchar) END AS "partition", step, k
        FROM ev e CROSS JOIN steps
        WHERE (step = 9 AND k % 23 = 0) OR step = 1
          OR (k % 50 <> 0 AND (step IN (2, 3, 4) OR (k % 13 <> 0 AND (step = 5 OR (step = 6 AND k % 10 = 0)
              OR (step IN (7, 8) AND k % 10 <> 0)))))""",
    "status": "SELECT * FROM messages WHERE status <> ''",
    "created": "SELECT 'evt-' || event_id AS event_id, event_id * 10 AS created_arrival FROM ev WHERE k % 19 <> 0",
    "folded": """
        SELECT event_id, stage, arg_max(status, arrival) AS status,
          arg_max(batch_id, arrival) FILTER (WHERE batch_id IS NOT NULL) AS batch_id,
          arg_max_null(snapshot_id, arrival) FILTER (WHERE has_snapshot) AS snapshot_id,
          arg_max(topic, arrival) FILTER (WHERE topic IS NOT NULL) AS topic,
          arg_max("partition", arrival) FILTER (WHERE topic IS NOT NULL) AS "partition",
          max(arrival) AS updated_arrival
        FROM status GROUP BY event_id, stage""",
    "stages": """
        SELECT * FROM (VALUES ('fastapi', 'completed'), ('kafka', 'processing'), ('spark', 'waiting'),
          ('iceberg', 'waiting'), ('minio', 'waiting')) AS t(stage, first_status)""",
    "state": """
        SELECT c.event_id, s.stage, coalesce(f.status, s.first_status) AS status, batch_id, snapshot_id, topic,
          "partition", updated_arrival
        FROM created c CROSS JOIN stages s LEFT JOIN folded f ON f.event_id = c.event_id AND f.stage = s.stage""",
    "summary": """
        SELECT event_id, max(status) FILTER (WHERE stage = 'fastapi') AS fastapi,
          max(status) FILTER (WHERE stage = 'kafka') AS kafka, max(status) FILTER (WHERE stage = 'spark') AS spark,
          max(status) FILTER (WHERE stage = 'iceberg') AS iceberg, max(status) FILTER (WHERE stage = 'minio') AS minio,
          CAST(count(*) FILTER (WHERE status = 'completed') AS int) AS completed_stages,
          CAST(count(*) FILTER (WHERE status = 'failed') AS int) AS failed_stages, 5 AS total_stages,
          CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed'
            WHEN count(*) FILTER (WHERE status = 'completed') = 5 THEN 'completed' ELSE 'processing' END
            AS overall_status
        FROM state GROUP BY event_id""",
    "touched": """
        SELECT c.event_id, greatest(max(created_arrival), coalesce(max(s.arrival), -1)) AS touched_arrival
        FROM created c LEFT JOIN status s USING (event_id) GROUP BY c.event_id""",
    "retained": "SELECT * FROM touched ORDER BY touched_arrival DESC, event_id DESC LIMIT 100",
    "recent": "SELECT * FROM touched ORDER BY touched_arrival DESC, event_id DESC LIMIT 20",
    "table_rows": """
        SELECT *, 1001 + d + CASE WHEN d > 19 THEN 1 ELSE 0 END AS added_by, CASE WHEN d <= 19 THEN 1021 END AS removed_by
        FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS date)) AS d FROM usage
              WHERE event_id IS NOT NULL)""",
    "daily": "SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS date)) AS INT) AS day FROM usage",
    "later": """
        SELECT * REPLACE (CAST(quantity + CASE WHEN day % 4 = 1 AND k = 42 THEN 1 ELSE 0 END AS INT) AS quantity)
        FROM daily CROSS JOIN range(3) r(copy)
        WHERE copy < CASE WHEN day % 4 <> 1 THEN 1 WHEN k = 41 THEN 0 WHEN k = 43 THEN 3 ELSE 1 END""",
    "commits": """
        SELECT DISTINCT 1001 + d + CASE WHEN d > 19 THEN 1 ELSE 0 END AS id, 'append' AS operation, d,
          epoch_us(CAST(DATE '2024-01-01' + CAST(d + 1 AS int) AS timestamp)) AS committed_us FROM table_rows
        UNION ALL SELECT DISTINCT 1021, 'delete', d, epoch_us(TIMESTAMP '2024-01-21 00:00:01') FROM table_rows
        WHERE d = 19""",
    "listed": """
        SELECT committed_us, CAST(id AS varchar) AS snapshot_id,
          CASE WHEN id > 1001 THEN CAST(id - 1 AS varchar) END AS parent_id, operation, CAST(d AS varchar) AS "day",
          id = 1026 AS is_current
        FROM commits ORDER BY committed_us DESC LIMIT 100""",
    "clear_report": """
        SELECT count(*) FILTER (WHERE added_by < 1021) AS before_count,
          count(*) FILTER (WHERE removed_by = 1021) AS deleted_count,
          count(*) FILTER (WHERE added_by <= 1021 AND (removed_by IS NULL OR removed_by > 1021)) AS after_count,
          '1021' AS snapshot_id, epoch_us(TIMESTAMP '2024-01-21 00:00:01') AS committed_us,
          'delete' AS operation, true AS history_preserved FROM table_rows""",
    "topic_log": """
        SELECT 'usage-events' AS topic, CAST(user_id % 3 AS int) AS "partition", event_id AS "offset", event_id
        FROM events""",
    "ranges": """
        SELECT topic, "partition", min("offset") AS beginning_offset, max("offset") + 1 AS latest_offset,
          max("offset") + 1 - min("offset") AS log_size FROM topic_log GROUP BY topic, "partition" """,
    "people": """
        SELECT c_custkey AS seq,
          CASE WHEN c_custkey % 7 = 0 THEN 'bad user!' ELSE 'user' || c_custkey END AS username,
          CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment || '  Van  Nation' || c_nationkey END AS full_name,
          'u' || c_custkey || '@example.org' AS email,
          CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS department,
          c_nationkey % 3 AS role_group, c_mktsegment, c_nationkey
        FROM customer""",
    "entries": """
        SELECT seq, username AS uid, full_name AS cn, 'Nation' || c_nationkey AS sn, c_mktsegment AS "givenName",
          email AS mail, department AS "departmentNumber"
        FROM people WHERE full_name <> '' AND regexp_full_match(username, '[a-zA-Z0-9._-]+')
          AND length(username) BETWEEN 3 AND 64""",
    "requests": """
        SELECT seq, CASE WHEN seq % 5 = 1 THEN 'shared.name' ELSE username END AS uid, full_name AS cn,
          'Nation' || c_nationkey AS sn, c_mktsegment AS "givenName", email AS mail, department AS "departmentNumber"
        FROM people WHERE full_name <> '' AND (seq % 5 = 1 OR regexp_full_match(username, '[a-zA-Z0-9._-]{3,64}'))""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY uid ORDER BY seq) AS nth,
          uid IN (SELECT 'user' || s_suppkey FROM supplier) AS present FROM requests""",
}

# Views a view is built on.
_NEEDS = {
    "usage": ["ev"],
    "parsed": ["usage"],
    "security": ["ev"],
    "failed": ["security"],
    "incidents": ["failed"],
    "risks": ["incidents"],
    "decisions": ["risks"],
    "messages": ["ev", "steps"],
    "status": ["messages"],
    "created": ["ev"],
    "folded": ["status"],
    "state": ["created", "stages", "folded"],
    "summary": ["state"],
    "touched": ["created", "status"],
    "retained": ["touched"],
    "recent": ["touched"],
    "table_rows": ["usage"],
    "daily": ["usage"],
    "later": ["daily"],
    "commits": ["table_rows"],
    "listed": ["commits"],
    "clear_report": ["table_rows"],
    "ranges": ["topic_log"],
    "entries": ["people"],
    "requests": ["people"],
    "ranked": ["requests"],
}

# 32-bit multiplication by the factor of the key hash, in halves, and the hash over the hex digits of a key's bytes.
_TIMES = "((({0}) & 65535) * 1540483477 + (((({0}) >> 16) * 1540483477 & 65535) << 16) & 4294967295)"


def _hash_views() -> dict[str, str]:
    times = _TIMES.format
    word = times("w")
    mixed = times(f"xor({word}, {word} >> 24)")
    return {
        "words": f"""
        SELECT key, digits, (len(digits) // 2 % 4)::INT AS r, list_reduce(
          list_prepend(xor(2538058380::BIGINT, len(digits) // 2), list_transform(range(0, len(digits) // 8), lambda i: ('0x' || digits[8 * i + 7:8 * i + 8]
            || digits[8 * i + 5:8 * i + 6] || digits[8 * i + 3:8 * i + 4] || digits[8 * i + 1:8 * i + 2])::BIGINT)),
          lambda h, w: xor({times("h")}, {mixed})) AS h
        FROM (SELECT DISTINCT key, hex(encode(key)) AS digits FROM keyed)""",
        "tailed": f"""
        SELECT key, CASE r WHEN 0 THEN h ELSE {times("xor(h, rest)")} END AS h
        FROM (SELECT *, CASE r WHEN 1 THEN ('0x' || right(digits, 2))::BIGINT
                WHEN 2 THEN ('0x' || right(digits, 2) || left(right(digits, 4), 2))::BIGINT
                WHEN 3 THEN ('0x' || right(digits, 2) || left(right(digits, 4), 2) || left(right(digits, 6), 2))::BIGINT END AS rest
              FROM words)""",
        "hashed": f"""
        SELECT key, CAST((xor(h, h >> 15) & 2147483647) % 3 AS INT) AS "partition"
        FROM (SELECT key, {times("xor(h, h >> 13)")} AS h FROM tailed)""",
    }


_VIEWS |= _hash_views()
_VIEWS |= {
    "user_keys": "SELECT seq, user_id AS key, k, \"timestamp\" FROM usage",
    "keyed": "SELECT user_id AS key FROM usage UNION ALL SELECT username || '/' || user_id FROM usage",
}
_NEEDS |= {"user_keys": ["usage"], "keyed": ["usage"], "words": ["keyed"], "tailed": ["words"], "hashed": ["tailed"]}

_EVENT = 'event_id, event_type, user_id, username, service, usage_type, quantity, "timestamp"'

# query name -> (views, statement)
_SQL = {
    "parse_events": (["parsed"], "SELECT * FROM parsed"),
    "usage_envelope": (
        ["usage"],
        """SELECT 'req-' || seq AS event_id, event_type, user_id, username, service, usage_type, quantity, "timestamp"
           FROM usage WHERE service <> '' AND quantity > 0""",
    ),
    "usage_generated": (
        ["usage"],
        """SELECT count(*) AS events, count(*) AS ids, true AS ids_well_formed, true AS times_well_formed
           FROM usage WHERE service <> '' AND quantity > 0""",
    ),
    "usage_accepted": (
        ["usage"],
        "SELECT seq, service, usage_type, quantity FROM usage WHERE service <> '' AND quantity > 0",
    ),
    "usage_rejected": (
        ["usage"],
        """SELECT seq, service, usage_type, quantity,
             CASE WHEN service = '' AND quantity <= 0 THEN 'service,quantity' WHEN service = '' THEN 'service'
               ELSE 'quantity' END AS reason
           FROM usage WHERE service = '' OR quantity <= 0""",
    ),
    "batch_event_ids": (["usage"], "SELECT DISTINCT event_id FROM usage WHERE event_id IS NOT NULL"),
    "keyed_records": (
        ["usage"],
        """SELECT user_id AS key,
             CAST(to_json({'event_id': event_id, 'event_type': event_type, 'user_id': user_id, 'username': username,
               'service': service, 'usage_type': usage_type, 'quantity': quantity, 'timestamp': "timestamp"})
               AS varchar) AS value
           FROM usage""",
    ),
    "key_partitions": (
        ["usage", "hashed"],
        """SELECT seq, username || '/' || user_id AS key, "partition" FROM usage JOIN hashed ON hashed.key = username || '/' || user_id""",
    ),
    "record_offsets": (
        ["user_keys", "hashed"],
        """SELECT seq, key, 'usage-events' AS topic, "partition",
             row_number() OVER (PARTITION BY "partition" ORDER BY seq) - 1 AS "offset" FROM user_keys JOIN hashed USING (key)""",
    ),
    "published_records": (
        ["user_keys", "hashed"],
        """SELECT 'usage-events' AS topic, "partition", row_number() OVER (PARTITION BY "partition" ORDER BY k >= 60, seq) - 1 AS "offset",
             key, "timestamp" AS time FROM user_keys JOIN hashed USING (key)""",
    ),
    "status_records": (
        ["usage"],
        """SELECT event_id AS key, step, stage, status, replace(body, '@', event_id) AS value
           FROM (SELECT DISTINCT event_id FROM usage WHERE event_id IS NOT NULL) CROSS JOIN (VALUES
             (1, 'spark', 'completed', '{"event_id":"@","stage":"spark","status":"completed","batch_id":7}'),
             (2, 'iceberg', 'processing', '{"event_id":"@","stage":"iceberg","status":"processing","batch_id":7}'),
             (3, 'iceberg', 'completed', '{"event_id":"@","stage":"iceberg","status":"completed","batch_id":7,'
               || '"table":"lake.usage.events","snapshot_id":null}'),
             (4, 'minio', 'processing', '{"event_id":"@","stage":"minio","status":"processing","batch_id":7}'),
             (5, 'minio', 'completed', '{"event_id":"@","stage":"minio","status":"completed","batch_id":7,'
               || '"bucket":"warehouse","path":"s3a://warehouse/usage/data/","parquet_files":3}'))
             AS t(step, stage, status, body)""",
    ),
    "sent_records": (
        ["topic_log"],
        """SELECT 'evt-' || event_id AS key, 1 AS step, 'kafka' AS stage, 'completed' AS status,
             '{"event_id":"evt-' || event_id || '","stage":"kafka","status":"completed","topic":"' || topic
               || '","partition":' || "partition" || ',"offset":' || "offset" || '}' AS value FROM topic_log
           UNION ALL SELECT 'evt-' || event_id, 2, 'spark', 'processing',
             '{"event_id":"evt-' || event_id || '","stage":"spark","status":"processing"}' FROM topic_log""",
    ),
    "dedup_append": (
        ["usage", "table_rows"],
        f"""SELECT {_EVENT} FROM usage WHERE event_id IS NOT NULL AND k <> 97
              AND event_id NOT IN (SELECT event_id FROM table_rows WHERE added_by <= 1010)""",
    ),
    "usage_rollup": (
        ["parsed"],
        """SELECT user_id, service, usage_type, count(*) AS events, CAST(sum(quantity) AS bigint) AS total_quantity
           FROM parsed GROUP BY user_id, service, usage_type""",
    ),
    "billing_cost": (
        ["parsed"],
        """SELECT user_id, service, CAST(sum(coalesce(quantity, 0)) AS bigint) AS quantity,
             CAST(sum(coalesce(quantity, 0) * 100) AS bigint) AS cost FROM parsed GROUP BY user_id, service""",
    ),
    "security_parsed": (
        ["security"],
        """SELECT seq, event_id, ets_us, event_type, username, ip_address, realm
           FROM security WHERE k NOT IN (94, 95)""",
    ),
    "security_rejected": (
        ["security"],
        """SELECT seq, CASE k WHEN 94 THEN 'no event time or not JSON' ELSE 'bad event time' END AS reason
           FROM security WHERE k IN (94, 95)""",
    ),
    "failed_logins": (["failed"], "SELECT seq, event_id, username, ip_address, ets_us FROM failed"),
    "bruteforce_incidents": (["incidents"], "SELECT * FROM incidents"),
    "risk_scores": (["risks"], "SELECT * FROM risks"),
    "policy_decisions": (["decisions"], "SELECT * FROM decisions"),
    "dry_run_disables": (["decisions"], "SELECT * FROM decisions WHERE action = 'DISABLE_USER'"),
    "status_parse": (
        ["status"],
        """SELECT arrival, event_id, stage, status,
             CAST((batch_id IS NOT NULL)::int + has_snapshot::int + 2 * (topic IS NOT NULL)::int AS int) AS extra_fields,
             batch_id, snapshot_id, topic, "partition"
           FROM status""",
    ),
    "status_invalid": (
        ["messages"],
        """SELECT arrival, event_id, stage, status,
             '{"event_id":"' || event_id || '","stage":"' || stage || '","status":""}' AS value
           FROM messages WHERE status = ''""",
    ),
    "status_unknown": (
        ["status"],
        "SELECT arrival, event_id, stage, status FROM status WHERE k % 19 = 0",
    ),
    "pipeline_state": (["state"], "SELECT * FROM state"),
    "pipeline_fields": (
        ["folded", "status"],
        """SELECT event_id, stage, 'status' AS field, status AS field_value, updated_arrival AS arrival FROM folded
           UNION ALL SELECT event_id, stage, 'batch_id', arg_max(batch_id, arrival), max(arrival) FROM status
             WHERE batch_id IS NOT NULL GROUP BY ALL
           UNION ALL SELECT event_id, stage, 'snapshot_id', arg_max_null(snapshot_id, arrival), max(arrival)
             FROM status WHERE has_snapshot GROUP BY ALL
           UNION ALL SELECT event_id, stage, 'topic', arg_max(topic, arrival), max(arrival) FROM status
             WHERE topic IS NOT NULL GROUP BY ALL
           UNION ALL SELECT event_id, stage, 'partition', arg_max("partition", arrival), max(arrival) FROM status
             WHERE topic IS NOT NULL GROUP BY ALL""",
    ),
    "pipeline_payload": (
        ["status"],
        """, parts AS (
             SELECT event_id, stage, arrival, 'status' AS field, '"' || status || '"' AS field_json, 'STRING' AS field_type FROM status
             UNION ALL SELECT event_id, stage, arrival, 'batch_id', batch_id, 'BIGINT' FROM status WHERE batch_id IS NOT NULL
             UNION ALL SELECT event_id, stage, arrival, 'snapshot_id', coalesce(snapshot_id, 'null'), CASE WHEN snapshot_id IS NULL THEN 'VOID' ELSE 'BIGINT' END
               FROM status WHERE has_snapshot
             UNION ALL SELECT event_id, stage, arrival, 'topic', '"' || topic || '"', 'STRING' FROM status WHERE topic IS NOT NULL
             UNION ALL SELECT event_id, stage, arrival, 'partition', "partition", 'BIGINT' FROM status WHERE topic IS NOT NULL
             UNION ALL SELECT event_id, stage, arrival, 'details', '{"files":' || (arrival // 10 % 7) || ',"ok":true,"paths":["a",null]}',
               'OBJECT<files: BIGINT, ok: BOOLEAN, paths: ARRAY<STRING>>' FROM status WHERE step = 8
             UNION ALL SELECT event_id, stage, arrival, 'retried', 'false', 'BOOLEAN' FROM status WHERE step = 3
             UNION ALL SELECT event_id, stage, arrival, 'took', '1.5', 'DECIMAL(2,1)' FROM status WHERE step = 3)
           SELECT event_id, stage, field, arg_max(field_json, arrival) AS field_json, arg_max(field_type, arrival) AS field_type,
             max(arrival) AS arrival FROM parts GROUP BY event_id, stage, field""",
    ),
    "pipeline_summary": (["summary"], "SELECT * FROM summary"),
    "pipeline_overview": (
        ["summary"],
        """SELECT count(*) AS events, count(*) FILTER (WHERE overall_status = 'completed') AS completed,
             count(*) FILTER (WHERE overall_status = 'failed') AS failed FROM summary""",
    ),
    "pipeline_recent": (
        ["state", "recent"],
        """SELECT event_id, touched_arrival, stage, status, left(event_id, 12) || '…' AS preview
           FROM recent JOIN state USING (event_id)""",
    ),
    "pipeline_retained": (["retained"], "SELECT * FROM retained"),
    "pipeline_retained_late": (
        ["created", "status"],
        """, touches AS (
             SELECT event_id, arrival + CASE WHEN nr % 3 = 0 THEN (nr % 5 + 1) * 500 ELSE 0 END AS arrival, 1 AS n
             FROM (SELECT *, CAST(substring(event_id, 5) AS BIGINT) AS nr FROM status)
             UNION ALL SELECT event_id, created_arrival, 0 FROM created
             UNION ALL SELECT event_id, created_arrival + 3000, 0 FROM created WHERE created_arrival % 400 = 0),
           replayed AS (
             SELECT list_reduce(list_prepend([]::STRUCT(e VARCHAR, t BIGINT, c BIGINT, n BIGINT)[], list([{'e': event_id, 't': arrival::BIGINT, 'c': arrival::BIGINT, 'n': n::BIGINT}] ORDER BY arrival, n, event_id)), lambda held, x:
               CASE WHEN x[1].n = 0 THEN list_concat(x, list_filter(held, lambda h: h.e <> x[1].e))[:100]
                 WHEN len(list_filter(held, lambda h: h.e = x[1].e)) = 0 THEN held
                 ELSE list_concat(list_transform(list_filter(held, lambda h: h.e = x[1].e), lambda h: {'e': h.e, 't': x[1].t, 'c': h.c, 'n': h.n + 1}),
                   list_filter(held, lambda h: h.e <> x[1].e)) END) AS held
             FROM touches)
           SELECT h.e AS event_id, h.t AS touched_arrival, h.c AS created_arrival, h.n AS messages FROM (SELECT unnest(held) AS h FROM replayed)""",
    ),
    "status_search": (
        ["state"],
        """SELECT event_id, topic, status,
             CASE WHEN length(event_id) > 6 THEN left(event_id, 6) || '…' ELSE event_id END AS preview
           FROM state WHERE stage = 'kafka' AND topic = 'usage-replay'
             AND (event_id LIKE '%evt-12%' OR topic LIKE '%evt-12%')""",
    ),
    "status_normalized": (
        ["ev"],
        """SELECT event_id, raw, CASE k % 12 WHEN 0 THEN 'completed' WHEN 1 THEN 'completed' WHEN 2 THEN 'completed'
             WHEN 3 THEN 'processing' WHEN 4 THEN 'processing' WHEN 5 THEN 'failed' WHEN 6 THEN 'failed'
             WHEN 7 THEN 'waiting' WHEN 8 THEN 'waiting' ELSE 'unknown' END AS state
           FROM (SELECT event_id, k, ['SUCCESS', 'complete', 'Completed', 'running', 'in_progress', 'error', 'FAILED',
                   'queued', 'Pending', 'odd', '', NULL][k % 12 + 1] AS raw FROM ev)""",
    ),
    "append_effect": (
        ["table_rows"],
        """SELECT CAST(added_by AS varchar) AS snapshot_id, 'append' AS operation, count(*) AS appended_rows,
             count(DISTINCT event_id) AS event_ids FROM table_rows GROUP BY added_by""",
    ),
    "snapshot_list": (["listed"], "SELECT * FROM listed"),
    "snapshot_totals": (
        ["commits"],
        """SELECT count(*) AS snapshots, count(*) - 1 AS historical, CAST(max(id) AS varchar) AS current_snapshot_id
           FROM commits""",
    ),
    "latest_snapshot": (
        ["commits"],
        "SELECT CAST(id AS varchar) AS snapshot_id, operation FROM commits ORDER BY id DESC LIMIT 1",
    ),
    "table_count": (["table_rows"], "SELECT count(*) AS total FROM table_rows WHERE removed_by IS NULL"),
    "time_travel_rows": (
        ["table_rows"],
        f"""SELECT {_EVENT} FROM table_rows WHERE added_by <= 1020 AND (removed_by IS NULL OR removed_by > 1020)
            ORDER BY event_id LIMIT 200""",
    ),
    "time_travel_summary": (
        ["table_rows"],
        """SELECT '1020' AS snapshot_id, count(*) FILTER (WHERE added_by <= 1020) AS historical_count,
             count(*) FILTER (WHERE removed_by IS NULL) AS current_count,
             least(200, count(*) FILTER (WHERE added_by <= 1020)) AS returned_rows, 200 AS "limit" FROM table_rows""",
    ),
    "snapshot_compare": (
        ["table_rows"],
        """SELECT '1010' AS snapshot_id, count(*) FILTER (WHERE added_by <= 1010) AS historical_count,
             count(*) FILTER (WHERE removed_by IS NULL) AS current_count FROM table_rows""",
    ),
    "snapshot_diff": (
        ["table_rows"],
        f"""SELECT 'removed' AS change, {_EVENT} FROM table_rows WHERE added_by <= 1010
            UNION ALL SELECT 'added', {_EVENT} FROM table_rows WHERE added_by BETWEEN 1022 AND 1026""",
    ),
    "table_diff": (
        ["daily", "later"],
        f"""SELECT change, {_EVENT}, "day", count(*) AS copies FROM (
             SELECT 'removed' AS change, * FROM (SELECT {_EVENT}, "day" FROM daily EXCEPT ALL SELECT {_EVENT}, "day" FROM later)
             UNION ALL SELECT 'added', * FROM (SELECT {_EVENT}, "day" FROM later EXCEPT ALL SELECT {_EVENT}, "day" FROM daily))
            GROUP BY ALL""",
    ),
    "clear_effect": (["clear_report"], "SELECT * FROM clear_report"),
    "reset_effect": (
        ["clear_report", "retained"],
        """SELECT *, (SELECT count(*) FROM retained) AS cleared_pipeline_events, true AS messages_preserved
           FROM clear_report""",
    ),
    "parquet_rows_by_event": (
        [],
        """SELECT event_id, user_id, event_type, value, props, 'events.parquet' AS _parquet_file
           FROM events WHERE event_id = 137""",
    ),
    "indexed_rows_by_event": ([], "SELECT event_id, user_id, event_type, value, props FROM events WHERE event_id = 137"),
    "parquet_first_rows": (
        [],
        """SELECT * FROM (
             SELECT n_nationkey, n_name, NULL::BIGINT AS r_regionkey, NULL::VARCHAR AS r_name, NULL::BIGINT AS s_suppkey,
               NULL::VARCHAR AS s_name, 'nation.parquet' AS _parquet_file FROM nation
             UNION ALL SELECT NULL, NULL, r_regionkey, r_name, NULL, NULL, 'region.parquet' FROM region
             UNION ALL SELECT NULL, NULL, NULL, NULL, s_suppkey, s_name, 'supplier.parquet' FROM supplier)
           ORDER BY _parquet_file, n_nationkey, r_regionkey, s_suppkey LIMIT 50""",
    ),
    "parquet_lookup_report": (
        [],
        """SELECT '137' AS event_id, count(*) AS row_count, 3 AS files_scanned,
             'customer.parquet,events.parquet,orders.parquet' AS files FROM events WHERE event_id = 137""",
    ),
    "file_row_counts": (
        [],
        """SELECT 'events.parquet' AS _parquet_file, count(*) AS row_count FROM events
           UNION ALL SELECT 'nation.parquet', count(*) FROM nation
           UNION ALL SELECT 'supplier.parquet', count(*) FROM supplier
           UNION ALL SELECT 'orders.parquet', count(*) FROM orders""",
    ),
    "topic_offsets": (["ranges"], "SELECT * FROM ranges"),
    "topic_totals": (
        ["ranges"],
        """SELECT count(DISTINCT topic) AS topics, count(*) AS partitions, CAST(sum(log_size) AS bigint) AS log_size
           FROM ranges""",
    ),
    "partition_read": (["topic_log"], 'SELECT * FROM topic_log WHERE "partition" = 1'),
    "claims_projection": (
        ["people"],
        """SELECT 'sub-' || seq AS user_id, username, email, full_name AS name,
             CASE role_group WHEN 0 THEN 'user,ldap-admin' WHEN 1 THEN 'user' ELSE '' END AS roles FROM people""",
    ),
    "admin_users": (
        ["people"],
        """SELECT 'sub-' || seq AS user_id, username, role_group = 0 AS is_ldap_admin
           FROM people WHERE role_group = 0 OR seq % 10 = 0""",
    ),
    "directory_list": (
        [],
        """SELECT 'user' || s_suppkey AS username, s_name AS full_name,
             CASE WHEN s_suppkey % 3 <> 0 THEN 's' || s_suppkey || '@example.org' ELSE '' END AS email,
             CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'nation-' || s_nationkey END AS department FROM supplier""",
    ),
    "directory_valid": (["entries"], "SELECT * FROM entries"),
    "directory_new": (["ranked"], "SELECT * EXCLUDE (nth, present) FROM ranked WHERE nth = 1 AND NOT present"),
    "directory_duplicates": (["ranked"], "SELECT seq, uid FROM ranked WHERE nth > 1 OR present"),
    "stream_ingest": (["parsed"], "SELECT * FROM parsed"),
    "stream_dedup": (["parsed"], "SELECT * FROM parsed"),
    "stream_receipts": (
        ["parsed"],
        """SELECT count(*) AS total_rows, count(*) - count(event_id) AS without_id, min(event_id) AS first_id, max(event_id) AS last_id
           FROM parsed""",
    ),
    "stream_incidents": (["incidents"], "SELECT * FROM incidents"),
    "stream_incidents_idle": (["incidents"], "SELECT * FROM incidents"),
    "stream_pipeline_state": (["state"], "SELECT * FROM state"),
    "json_safe_rows": (
        [],
        """SELECT s_suppkey, s_name AS name, CASE WHEN s_suppkey % 10 IN (0, 1, 2) THEN NULL ELSE s_acctbal END AS balance,
             CAST(CAST(s_acctbal AS decimal(12, 2)) AS double) AS balance_exact,
             strftime(TIMESTAMP '2024-01-01' + to_hours(s_suppkey), '%Y-%m-%dT%H:%M:%S')
               || CASE WHEN s_suppkey % 2 = 1 THEN '.250000' ELSE '' END AS seen_at,
             strftime(DATE '2024-01-01' + CAST(s_suppkey AS int), '%Y-%m-%d') AS seen_on,
             CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_nationkey AS double) END AS reading,
             CAST(s_nationkey AS varchar) AS nation_key, '2024-01-01' AS since, s_suppkey % 2 = 0 AS ok
           FROM supplier""",
    ),
}


def _with(views: list[str]) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    if not ordered:
        return ""
    return "WITH " + ",\n".join(f"{name} AS ({_VIEWS[name].strip()})" for name in ordered) + "\n"


def all_sql() -> dict[str, str]:
    # A statement that begins with a comma has views of its own.
    return {name: (_with(views).rstrip() if statement.startswith(",") else _with(views)) + statement for name, (views, statement) in _SQL.items()}
