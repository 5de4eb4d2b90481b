"""The registered queries as DuckDB SQL on the same tables, written independently of the DataFrame code."""

from __future__ import annotations

from ferryline.operators import synth
from ferryline.sources.collections import COLLECTIONS

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"

VIEWS = {
    "v_items": """
SELECT o.o_orderkey AS item_id, c.c_name AS name,
  concat(lower(replace(c.c_name,'#','.')),'@example.com') AS email,
  CASE o.o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'processing'
    ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'failed' ELSE 'success' END END AS status,
  CAST(substr(o.o_orderpriority,1,1) AS INT) AS priority,
  lower(substr(o.o_orderpriority,3)) AS category,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE lower(c.c_mktsegment) END AS department,
  r.r_name AS region,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE CAST(o.o_orderkey % 5 AS INT) END AS retry_count,
  o.o_orderdate AS created_at, o.o_orderdate + to_days(CAST(o.o_orderkey % 7 AS INT)) AS updated_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_messages": """
SELECT event_id AS message_id, concat('job-', CAST(user_id AS VARCHAR)) AS correlation_id, ts AS published_at,
  CASE event_type WHEN 'click' THEN 'process.bulkUpdate' WHEN 'purchase' THEN 'priority.bulkUpdate'
    WHEN 'view' THEN 'archive.bulkMigration' WHEN 'error' THEN 'failed.manual' ELSE 'misc.signup' END AS routing_key,
  CASE event_type WHEN 'click' THEN 'processing' WHEN 'purchase' THEN 'priority'
    WHEN 'view' THEN 'archive' WHEN 'error' THEN 'deadletter' ELSE 'unknown' END AS queue_type,
  CAST(event_id % 11 AS INT) AS priority, k % 7 AS x_retries, NULLIF(k % 8, 0) AS death_count,
  k * 1000 AS ttl_ms, CAST(event_id % 8 AS INT) * 10000 AS wait_ms, event_id % 5 = 0 AS handler_failed, props AS body
FROM (SELECT *, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events)""",
    "v_job_log": """
SELECT event_id AS seq, concat('job-', CAST(user_id AS VARCHAR)) AS correlation_id,
  concat('parent-', CAST(user_id % 10 AS VARCHAR)) AS parent_job_id, ts AS event_ts,
  CASE event_type WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'completed'
    WHEN 'error' THEN 'failed' ELSE 'processing' END AS status,
  k + 1 AS total_items, CASE event_type WHEN 'purchase' THEN k + 1 ELSE 0 END AS processed_items
FROM (SELECT *, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events)""",
    "v_worker_log": """
SELECT event_id AS seq, CAST(user_id % 20 AS INT) AS worker_no,
  CASE user_id % 4 WHEN 0 THEN 'ProcessingConsumer' WHEN 1 THEN 'PriorityConsumer'
    WHEN 2 THEN 'DeadLetterConsumer' ELSE 'ArchiveConsumer' END AS consumer_type,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'ready'
    WHEN 'view' THEN 'exit' ELSE 'messageProcessed' END AS type,
  ts AS event_ts, CAST(round(value * 100) AS BIGINT) AS processing_ms
FROM events""",
    "v_archive": """
SELECT o_orderkey AS original_id, o_orderstatus AS status,
  concat('someModel_batch_', CAST(CAST(floor(o_orderkey / 100) AS BIGINT) + 1 AS VARCHAR)) AS archive_batch,
  o_orderdate + to_days(CAST(30 + 30 * g AS INT)) AS archived_at, CAST(g AS INT) AS run_no
FROM orders CROSS JOIN (SELECT range AS g FROM range(2)) t
WHERE o_orderkey % 3 <> 0 AND (g = 0 OR o_orderkey % 6 = 1)""",
    "v_errors": """
SELECT event_id AS error_id, ts AS event_ts,
  CASE CAST(json_extract_string(props,'$.k') AS INT) % 7
    WHEN 0 THEN 'NOT_FOUND - no queue app.x' WHEN 1 THEN 'queue does not exist'
    WHEN 2 THEN 'PRECONDITION_FAILED - inequivalent arg' WHEN 3 THEN 'PRECONDITION_FAILED - other'
    WHEN 4 THEN 'Channel closed' WHEN 5 THEN 'Connection closed' ELSE 'socket hang up' END AS message
FROM events WHERE event_type = 'error'""",
    # Policy of each queue: retries, delay, key once exhausted or rejected, key once expired.
    "policy": """
SELECT * FROM (VALUES
  ('processing', 'app.processing.queue', true, 3, 10000, 'failed.manual', 'failed.processing'),
  ('priority', 'app.priority.queue', true, 5, 5000, 'failed.manual', NULL),
  ('deadletter', 'app.deadletter.queue', false, NULL, NULL, NULL, NULL),
  ('retry', 'app.retry.queue', false, NULL, NULL, NULL, 'process.retry'),
  ('archive', 'app.archive.queue', true, 3, 15000, 'failed.manual', 'failed.archive'))
  AS p(queue_type, queue_name, retrying, max_retries, delay_ms, exhausted_key, expired_key)""",
}


def _with(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` with the views it names, and ``extra`` ones after them, in front."""
    extra = extra or {}
    text = " ".join([sql, *extra.values()])
    named = {name: body for name, body in VIEWS.items() if name in text}
    parts = [f"{name} AS ({body})" for name, body in {**named, **extra}.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + sql


def _ms(start: str, end: str) -> str:
    return f"date_sub('millisecond', {start}, {end})"


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%gZ')"


# The columns of a status transition, for rows of v_items called i.
def _transition(run: str) -> str:
    return f"""i.item_id, 'success' AS status,
  CASE WHEN i.status = 'failed' THEN coalesce(i.retry_count, 0) + 1 ELSE coalesce(i.retry_count, -1) END AS retry_count,
  CASE WHEN i.status = 'failed' THEN {AS_OF} END AS last_retry_at,
  CASE WHEN i.status = 'processing' THEN {_ms('i.updated_at', AS_OF)} ELSE -1 END AS processing_duration_ms,
  {AS_OF} AS last_processed, {run} AS processed_by, true AS processing_completed, i.department"""


_KEPT = """i.item_id, i.status, coalesce(i.retry_count, -1) AS retry_count, CAST(NULL AS TIMESTAMP) AS last_retry_at,
  CAST(-1 AS BIGINT) AS processing_duration_ms, CAST(NULL AS TIMESTAMP) AS last_processed,
  CAST(NULL AS VARCHAR) AS processed_by, false AS processing_completed, i.department"""

_BATCHED = """SELECT *, CAST(ceil(row_number() OVER (ORDER BY item_id) / 100.0) AS BIGINT) AS batch_number FROM v_items"""
_CUT_BODY = "CASE WHEN message_id % 7 = 0 THEN substr(body, 1, length(body) - 1) ELSE body END"

_JUDGED = """SELECT m.*, p.queue_name, p.delay_ms, CASE WHEN p.retrying THEN p.exhausted_key ELSE p.expired_key END AS dead_key,
    coalesce(p.retrying AND m.x_retries < p.max_retries, false) AS again
  FROM {source} m LEFT JOIN policy p ON m.queue_type = p.queue_type"""
_OUTCOME = "CASE WHEN again THEN 'retry' WHEN dead_key IS NOT NULL THEN 'dead_letter' ELSE 'dropped' END"
_SPLIT = f"""SELECT *, CASE WHEN handler_failed THEN {_OUTCOME} ELSE 'ok' END AS outcome FROM judged"""

_LINES = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS place
  FROM (SELECT l_orderkey + CASE WHEN l_quantity > 45 THEN 1000000000 ELSE 0 END AS item_id,
    CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'success' END AS status,
    l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem)) WHERE place = 1"""
_LINE_JOIN = """SELECT coalesce(i.item_id, u.item_id) AS item_id,
    CASE WHEN u.item_id IS NULL THEN 'untouched' WHEN i.item_id IS NULL THEN 'unmatched' ELSE 'matched' END AS outcome,
    u.item_id IS NOT NULL AND i.item_id IS NOT NULL AND u.status IS DISTINCT FROM i.status AS modified
  FROM v_items i FULL OUTER JOIN line_updates u ON i.item_id = u.item_id"""

_LATEST_JOB = """SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
    PARTITION BY correlation_id ORDER BY event_ts DESC, seq DESC) AS place FROM v_job_log) WHERE place = 1"""
_LATEST_ARCHIVE = """SELECT original_id, status, archive_batch, archived_at, run_no FROM (SELECT *, row_number() OVER (
    PARTITION BY original_id ORDER BY archived_at DESC, run_no DESC) AS place FROM {source}) WHERE place = 1"""
_WORKERS = f"""SELECT worker_no, consumer_type, count(*) FILTER (type = 'messageProcessed') AS messages_processed,
    count(*) FILTER (type = 'error') AS errors, min(event_ts) AS first_activity, max(event_ts) AS last_activity,
    {_ms('min(event_ts)', AS_OF)} AS uptime_ms FROM v_worker_log GROUP BY worker_no, consumer_type"""
_TRIAGE = """CASE WHEN deaths >= 5 THEN 'permanently_failed' WHEN deaths >= 3 THEN 'manual_review' ELSE 'requeued' END"""
_NEXT_ENTRY = """SELECT *, lead(event_ts) OVER (PARTITION BY correlation_id ORDER BY event_ts, seq) AS next_ts FROM v_job_log"""


def _late(end: str) -> str:
    return f"""SELECT correlation_id, seq, event_ts AS started_at, event_ts + INTERVAL 300 SECOND AS failed_at,
  'failed' AS status, 'Processing worker timeout exceeded' AS message FROM entries WHERE status = 'processing' AND {end}"""


def _draw(salt: str, n: int, key: str = "o_orderkey") -> str:
    return f"(('0x' || substr(md5('42:' || {key} || ':{salt}'), 1, 8))::BIGINT % {n})"


def _chosen(salt: str, values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_draw(salt, len(values))} + 1]"


def _synth_items() -> str:
    template = f"{_draw('template', 5)} + 1"
    return f"""SELECT o_orderkey AS item_id, first || ' ' || last AS name,
  lower(first) || '.' || lower(last) || {_draw('number', 1000)} || '@' || {_chosen('domain', synth.DOMAINS)} AS email,
  {_chosen('status', synth.ITEM_STATUSES)} AS status, CAST({template} AS INT) AS priority,
  (['urgent','normal','low','maintenance','review'])[{template}] AS category,
  (['sales','marketing','support','tech','admin'])[{template}] AS department,
  {_draw('version', 10)} + 1 AS version, 'Generated test data for ' || first || ' ' || last AS notes,
  'seed-service' AS source, {_chosen('region', synth.REGIONS)} AS region,
  {AS_OF} AS last_modified, 'batch-' || epoch_ms({AS_OF}) AS batch,
  {AS_OF} - to_seconds({_draw('age', 90 * 86400)}) AS created_at, {AS_OF} AS updated_at
FROM (SELECT o_orderkey, {_chosen('first', synth.FIRST_NAMES)} AS first, {_chosen('last', synth.LAST_NAMES)} AS last FROM orders)"""


def _synth_jobs() -> str:
    name = "'job-' || CASE WHEN o_orderkey < 1000000 THEN lpad(o_orderkey::VARCHAR, 6, '0') ELSE o_orderkey::VARCHAR END"
    return f"""SELECT {name} AS job_id, {name} AS correlation_id, status, created_at,
  CASE WHEN status IN ('completed', 'failed') THEN created_at + to_seconds({_draw('job-run', 86400)}) END AS completed_at,
  {_draw('job-items', 1000)} + 1 AS total_items,
  CASE WHEN status = 'failed' THEN 'Random error: ' || {_chosen('job-error', synth.JOB_ERRORS)} END AS error
FROM (SELECT o_orderkey, {_chosen('job-status', synth.JOB_DRAWN_STATUSES)} AS status,
  {AS_OF} - to_seconds({_draw('job-age', 30 * 86400)}) AS created_at FROM orders)"""


_BATCH_COUNTS = """SELECT 'someModel_batch_' || batch_number AS archive_batch, count(*) AS archived FROM batched GROUP BY batch_number"""

ORACLES: dict[str, str] = {
    "scan_collection": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 1000",
    "decode_messages": _with(
        "SELECT message_id, CAST(json_extract_string(body, '$.k') AS INT) AS k FROM v_messages WHERE message_id % 7 <> 0"
    ),
    "decode_messages_bad": _with(
        f"SELECT message_id, {_CUT_BODY} AS body, 'undecodable body' AS error FROM v_messages WHERE message_id % 7 = 0"
    ),
    "stream_scan": "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "table_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COLLECTIONS
    ),
    "append_valid": _with(
        "SELECT item_id, name, status, priority, department, 'first' AS run_id FROM v_items "
        "WHERE department IS NOT NULL AND priority BETWEEN 1 AND 4"
    ),
    "publish_batches": """
SELECT 'someModel_batch_' || n AS correlation_id, md5('0:message_id:someModel_batch_' || n) AS message_id,
  'app.topic.exchange' AS exchange, 'priority.bulkUpdate' AS routing_key, 'app.processing.queue' AS reported_queue,
  'app.priority.queue' AS delivered_queue, 7 AS priority, '30000' AS expiration, CAST(size AS VARCHAR) AS h_batch_size,
  'high' AS h_priority, count(*) OVER () AS total_batches
FROM (SELECT n, count(*) AS size FROM (SELECT CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 100.0) AS BIGINT) AS n
  FROM orders) GROUP BY n)""",
    "published_jobs": f"""
SELECT 'someModel_batch_' || n AS job_id, 'someModel_batch_' || n AS correlation_id, 'pending' AS status, 'batch' AS job_type,
  count(*) AS total_items, CAST(0 AS BIGINT) AS processed_items, CAST(0 AS DOUBLE) AS progress, {AS_OF} AS event_ts
FROM (SELECT CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 100.0) AS BIGINT) AS n FROM orders) GROUP BY n""",
    "keyed_update": _with(
        f"SELECT {_transition(chr(39) + 'run-1' + chr(39))} FROM v_items i WHERE i.status <> 'success' AND i.item_id % 2 = 0 "
        f"UNION ALL SELECT {_KEPT} FROM v_items i WHERE NOT (i.status <> 'success' AND i.item_id % 2 = 0)"
    ),
    "keyed_update_folders": _with(
        f"SELECT {_transition(chr(39) + 'run-1' + chr(39))} FROM v_items i WHERE i.status <> 'success' AND i.item_id % 2 = 0 "
        f"UNION ALL SELECT {_KEPT} FROM v_items i WHERE NOT (i.status <> 'success' AND i.item_id % 2 = 0)"
    ),
    "job_transition": _with(
        "SELECT seq, correlation_id, event_ts, status FROM v_job_log UNION ALL "
        f"SELECT event_id + 1000000000, 'job-' || user_id, {AS_OF}, 'cancelled' FROM events WHERE event_id % 2 = 0"
    ),
    "delete_archived": _with("SELECT item_id, status FROM v_items WHERE item_id % 3 = 0"),
    "clear_tables": """
SELECT 'orders' AS table_name, count(*) AS rows_removed FROM orders
UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'total', (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM events)""",
    "filter_spec": _with(
        "SELECT item_id, status, priority, department FROM v_items "
        "WHERE (status = 'failed' OR priority <= 2) AND department IS DISTINCT FROM 'building'"
    ),
    "count_where": _with(
        "SELECT count(*) AS row_count FROM v_items WHERE status IN ('pending', 'failed') AND department IS NULL"
    ),
    "status_counts": _with(
        "SELECT count(*) AS total_count, count(*) FILTER (status = 'pending') AS pending_count, "
        "count(*) FILTER (status = 'processing') AS processing_count, count(*) FILTER (status = 'success') AS success_count, "
        "count(*) FILTER (status = 'failed') AS failed_count FROM v_items"
    ),
    "validate_rows": _with("""
SELECT item_id, concat_ws('; ', CASE WHEN department IS NULL THEN 'department is required' END,
  CASE WHEN priority NOT BETWEEN 1 AND 4 THEN 'priority is out of range' END,
  CASE WHEN copies > 1 THEN 'email,created_at is not unique' END) AS reasons
FROM (SELECT *, count(*) OVER (PARTITION BY email, created_at) AS copies FROM v_items)
WHERE department IS NULL OR priority NOT BETWEEN 1 AND 4 OR copies > 1"""),
    "validate_jobs": f"""
SELECT correlation_id, status, CAST(0 AS DOUBLE) AS progress, 'batch' AS job_type,
  'job_id is required' || CASE WHEN status = 'success' THEN '; status is not allowed' ELSE '' END AS reasons
FROM (SELECT correlation_id, CASE WHEN status = 'completed' THEN 'success' ELSE status END AS status
  FROM ({_synth_jobs()}) WHERE CAST(right(correlation_id, 1) AS INT) % 2 = 0)""",
    "archive_defaults": _with(f"""
SELECT item_id AS original_id, CASE WHEN item_id % 4 = 0 THEN 'pending' ELSE status END AS status, {AS_OF} AS archived_at,
  'bulk_migration' AS archive_reason, 'somemodels' AS source_collection, 'archive-worker' AS archived_by,
  CASE WHEN item_id % 3 = 0 THEN 1 ELSE priority END AS priority, category, coalesce(department, 'general') AS department,
  1 AS version, {AS_OF} AS last_modified, 'migration' AS source, region FROM v_items"""),
    "fill_defaults": _with(
        "SELECT item_id, coalesce(department, 'general') AS department, coalesce(department, 'general') AS nested_department, "
        "category, 'bulk_migration' AS archive_reason FROM v_items"
    ),
    "work_set": _with("SELECT item_id, status FROM v_items WHERE status IN ('pending', 'processing', 'failed')"),
    "archive_rows": _with(f"""
SELECT name, email, status, priority, category, department, region, item_id AS original_id, {AS_OF} AS archived_at,
  'someModel_batch_' || (CAST(floor(item_id / 100) AS BIGINT) + 1) AS archive_batch, 'bulk_migration' AS archive_reason,
  'somemodels' AS source_collection, 'archive-worker' AS archived_by, created_at AS original_created_at,
  updated_at AS original_updated_at FROM v_items"""),
    "status_transition": _with(f"SELECT {_transition(chr(39) + 'run-1' + chr(39))} FROM v_items i"),
    "processing_duration": _with(
        f"SELECT item_id, {_ms('CASE WHEN item_id % 4 = 0 THEN created_at ELSE updated_at END', AS_OF)} AS duration_ms "
        "FROM v_items WHERE status = 'processing'"
    ),
    "route_message": _with("""
SELECT message_id, CASE WHEN priority > 5 THEN CASE WHEN queue_type = 'archive' THEN 'priority.bulkMigration' ELSE 'priority.bulkUpdate' END
    WHEN queue_type = 'archive' THEN 'archive.bulkMigration' WHEN queue_type = 'priority' THEN 'priority.bulkUpdate'
    ELSE 'process.bulkUpdate' END AS routing_key,
  CASE queue_type WHEN 'archive' THEN 'app.archive.queue' WHEN 'priority' THEN 'app.priority.queue'
    ELSE 'app.processing.queue' END AS reported_queue,
  CASE WHEN priority > 5 OR queue_type = 'priority' THEN 'app.priority.queue' WHEN queue_type = 'archive' THEN 'app.archive.queue'
    ELSE 'app.processing.queue' END AS delivered_queue FROM v_messages"""),
    "message_headers": _with(f"""
SELECT message_id, CAST(x_retries + 1 AS VARCHAR) AS h_batch_size, 'queue-service' AS h_source,
  {_iso('published_at')} AS h_timestamp, CASE WHEN priority > 5 THEN 'high' ELSE 'normal' END AS h_priority,
  queue_type AS h_queue_type, {_iso('published_at')} AS h_published_at,
  CASE WHEN ttl_ms > 30000 THEN CAST(ttl_ms - 30000 AS VARCHAR) END AS expiration FROM v_messages"""),
    "ensure_ids": _with("""
SELECT message_id AS number,
  CASE WHEN message_id % 4 < 2 THEN md5('42:correlation_id:' || message_id) ELSE correlation_id END AS correlation_id,
  CASE WHEN message_id % 5 = 0 THEN md5('42:message_id:' || message_id) ELSE CAST(message_id AS VARCHAR) END AS message_id
FROM v_messages"""),
    "unwrap_batches": _with(
        "SELECT 'someModel_batch_' || batch_number AS batch_id, 'someModel_batch_' || batch_number AS correlation_id, "
        "* REPLACE (coalesce(retry_count, -1) AS retry_count), '2024-02-01T00:00:00.000Z' AS sent_at FROM batched", {"batched": _BATCHED}
    ),
    "unwrap_batches_errors": _with("""
SELECT message_id, 'e' AS batch_id, '{"batchId": "e", "collection": "someModel", "data": []}' AS body,
  'batch must carry a non-empty data array' AS error FROM v_messages WHERE message_id % 3 = 2"""),
    "classify_errors": _with("""
SELECT error_id, CASE WHEN message IN ('NOT_FOUND - no queue app.x', 'queue does not exist') THEN 'QueueNotFoundError'
    WHEN starts_with(message, 'PRECONDITION') THEN 'QueueConfigurationError'
    WHEN message LIKE '%closed' THEN 'ConnectionError' ELSE 'RabbitMQError' END AS error_class,
  CASE WHEN message IN ('NOT_FOUND - no queue app.x', 'queue does not exist') THEN 404
    WHEN starts_with(message, 'PRECONDITION') THEN 409 ELSE 503 END AS status_code,
  CASE WHEN message LIKE '%inequivalent arg%' THEN 'Unable to retrieve stats due to declaration mismatch.' ELSE '' END AS detail
FROM v_errors"""),
    "error_severity": _with("""
SELECT error_id, code AS status_code, CASE WHEN code >= 500 OR error_id % 7 = 0 THEN 'critical'
  WHEN code >= 400 THEN 'client_error' ELSE 'info' END AS severity
FROM (SELECT error_id, CASE WHEN error_id % 5 = 0 THEN 200
  WHEN message LIKE 'NOT_FOUND%' OR message LIKE '%does not exist' THEN 404
  WHEN message LIKE 'PRECONDITION_FAILED%' THEN 409 ELSE 503 END AS code FROM v_errors)"""),
    "mask_credentials":
        "SELECT page_id, regexp_replace('amqp://user' || page_id || ':p@ss@' || substr(url, 9), '//.*@', '//***:***@') AS masked FROM pages",
    "synth_items": _synth_items(),
    "synth_jobs": _synth_jobs(),
    "topic_route": _with("""
SELECT message_id, routing_key, queue FROM v_messages LEFT JOIN (VALUES ('process', 'app.processing.queue'),
  ('priority', 'app.priority.queue'), ('archive', 'app.archive.queue'), ('failed', 'app.deadletter.queue'),
  ('process', 'audit'), ('priority', 'audit'), ('archive', 'audit')) b(word, queue) ON split_part(routing_key, '.', 1) = word"""),
    "filter_free_fields": _with("""
SELECT item_id, status FROM v_items WHERE status <> 'success' AND (region = 'EUROPE' AND item_id % 2 = 0
  OR priority >= 4 AND department IS NULL OR region = 'ASIA' AND priority < 2)"""),
    "topic_route_table": _with("""
SELECT m.message_id, m.routing_key, count(DISTINCT queue) AS queues, min(queue) AS first_queue, max(queue) AS last_queue
FROM keyed m LEFT JOIN found f ON f.message_id = m.message_id GROUP BY ALL""", {
        "keyed": """SELECT message_id, split_part(routing_key, '.', 1) AS w1, split_part(routing_key, '.', 2) AS w2,
  substr(correlation_id, 5) AS u, message_id % 100 AS k,
  routing_key || '.u' || substr(correlation_id, 5) || '.k' || (message_id % 100) AS routing_key FROM v_messages""",
        "bound": """SELECT o_orderkey % 6 AS kind, ['process', 'priority', 'archive', 'failed', 'misc'][o_orderkey % 5 + 1] AS w1,
  CAST(o_custkey % 150 AS VARCHAR) AS u, o_orderkey % 100 AS k, 'queue-' || (o_orderkey % 40) AS queue FROM orders""",
        "found": """SELECT message_id, queue FROM keyed m JOIN bound b ON b.u = m.u AND b.k = m.k
  WHERE kind IN (2, 4) OR kind = 0 AND b.w1 = m.w1 AND m.w2 = 'bulkUpdate'
  UNION SELECT message_id, queue FROM keyed m JOIN bound b ON b.w1 = m.w1 AND b.u = m.u WHERE kind = 1
  UNION SELECT message_id, queue FROM keyed m JOIN bound b ON b.w1 = m.w1 AND b.k = m.k WHERE kind = 3"""}),
    "to_kafka_rows": """
SELECT 'app.priority.queue' AS topic, 'someModel_batch_' || n AS key, 'someModel_batch_' || n AS batch_id, count(*) AS items,
  CAST(6 AS BIGINT) AS headers, 'processing' AS queue_type
FROM (SELECT CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 100.0) AS BIGINT) AS n FROM orders) GROUP BY n""",
    "update_join": _with("SELECT * FROM line_join", {"line_updates": _LINES, "line_join": _LINE_JOIN}),
    "archive_reconcile_missing": _with("SELECT item_id, email FROM v_items WHERE item_id NOT IN (SELECT original_id FROM v_archive)"),
    "archive_reconcile_present": _with("SELECT item_id, email FROM v_items WHERE item_id IN (SELECT original_id FROM v_archive)"),
    "archive_reconcile": _with("SELECT archive_batch, count(*) AS archived FROM v_archive GROUP BY archive_batch"),
    "find_by_original": _with(
        _LATEST_ARCHIVE.format(source="wanted"),
        {"wanted": "SELECT * FROM v_archive WHERE original_id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)"},
    ),
    "dead_letter_jobs": _with("""
SELECT m.message_id, CASE WHEN m.message_id % 3 = 0 THEN m.correlation_id || '-unknown' ELSE m.correlation_id END AS correlation_id,
  m.priority, j.status AS job_status, j.event_ts AS job_changed_at
FROM v_messages m LEFT JOIN latest j ON m.correlation_id = j.correlation_id AND m.message_id % 3 <> 0
WHERE m.queue_type = 'deadletter'""", {"latest": _LATEST_JOB}),
    "archive_stats": _with("SELECT status, count(*) AS archived, max(archived_at) AS latest_archive FROM v_archive GROUP BY status"),
    "queue_depth": _with("""
SELECT CASE WHEN grouping(queue_type) = 1 THEN 'total' ELSE queue_type END AS queue_type,
  CAST(sum(messages) AS BIGINT) AS messages, CAST(sum(consumers) AS BIGINT) AS consumers
FROM (SELECT queue_type, count(*) AS messages, 0 AS consumers FROM v_messages GROUP BY queue_type
  UNION ALL SELECT unnest(['processing', 'priority', 'deadletter', 'retry', 'archive']), 0, 0
  UNION ALL SELECT CASE consumer_type WHEN 'ProcessingConsumer' THEN 'processing' WHEN 'PriorityConsumer' THEN 'priority'
    WHEN 'DeadLetterConsumer' THEN 'deadletter' ELSE 'archive' END, 0, count(DISTINCT worker_no)
  FROM v_worker_log GROUP BY 1) GROUP BY ROLLUP (queue_type)"""),
    "run_summary": _with(f"""
SELECT run_id, total_rows, batches, seconds, CAST(round(total_rows / seconds) AS BIGINT) AS rows_per_second,
  round(total_rows / seconds, 6) AS exact_rate
FROM (SELECT consumer_type AS run_id, CAST(sum(processing_ms % 500 + 1) AS BIGINT) AS total_rows, count(*) AS batches,
  {_ms('min(event_ts)', 'max(event_ts)')} / 1000.0::DOUBLE AS seconds FROM v_worker_log GROUP BY consumer_type)"""),
    "worker_stats": _with(_WORKERS),
    "worker_health": _with("""
SELECT total_workers, healthy_workers, unhealthy_workers, total_workers - healthy_workers - unhealthy_workers AS other_workers,
  CASE WHEN unhealthy_workers = 0 THEN 'healthy' ELSE 'unhealthy' END AS status
FROM (SELECT count(*) AS total_workers, count(*) FILTER (type IN ('ready', 'messageProcessed')) AS healthy_workers,
  count(*) FILTER (type = 'error') AS unhealthy_workers FROM (SELECT *, row_number() OVER (
    PARTITION BY worker_no ORDER BY event_ts DESC, seq DESC) AS place FROM v_worker_log) WHERE place = 1)"""),
    "worker_counters": _with("""
SELECT created, greatest(0, created - gone) AS active, greatest(0, created - greatest(0, created - gone)) AS completed
FROM (SELECT count(*) FILTER (type = 'ready') AS created, count(*) FILTER (type = 'exit') AS gone FROM v_worker_log)"""),
    "processing_rate": _with(
        "SELECT worker_no, consumer_type, messages_processed, errors, "
        "CAST(round(messages_processed * 1000.0::DOUBLE / uptime_ms) AS BIGINT) AS rate, "
        "round(messages_processed * 1000.0::DOUBLE / uptime_ms, 6) AS exact_rate FROM workers", {"workers": _WORKERS}
    ),
    "job_progress": _with("""
SELECT *, round(least(100, CASE WHEN total_items = 0 THEN 0 ELSE processed_items * 100.0::DOUBLE / total_items END), 4) AS progress
FROM (SELECT parent_job_id, count(*) AS total_batches, count(*) FILTER (status = 'completed') AS completed_batches,
  count(*) FILTER (status = 'failed') AS failed_batches, CAST(sum(total_items) AS BIGINT) AS total_items,
  CAST(sum(processed_items) AS BIGINT) AS processed_items FROM latest GROUP BY parent_job_id)""", {"latest": _LATEST_JOB}),
    "update_counts": _with(
        "SELECT count(*) FILTER (outcome <> 'untouched') AS processed, count(*) FILTER (outcome = 'matched') AS matched, "
        "count(*) FILTER (modified) AS modified FROM line_join", {"line_updates": _LINES, "line_join": _LINE_JOIN}
    ),
    "batch_latency": _with(
        "SELECT consumer_type, count(*) AS batches, round(avg(processing_ms), 6) AS mean_ms, max(processing_ms) AS max_ms "
        "FROM v_worker_log WHERE type = 'messageProcessed' GROUP BY consumer_type"
    ),
    "dead_letter_backlog": _with("SELECT count(*) AS available_messages FROM v_messages WHERE queue_type = 'deadletter'"),
    "make_batches": """
SELECT 'someModel_batch_' || batch_number AS batch_id, 'someModel' AS collection, count(*) AS batch_size, batch_number,
  count(*) OVER () AS total_batches, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS item_ids
FROM (SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 100.0) AS BIGINT) AS batch_number FROM orders)
GROUP BY batch_number""",
    "latest_state": _with(_LATEST_JOB),
    "attempt_number": _with(f"""
SELECT correlation_id, seq, attempt, CAST(3 AS BIGINT) AS max_retries, attempt > 3 AS exhausted,
  CAST(attempt AS VARCHAR) AS x_retries, 'app.processing.queue' AS x_original_queue, 'handler failed' AS x_retry_reason,
  {_iso('event_ts')} AS x_retry_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY correlation_id ORDER BY event_ts, seq) AS attempt
  FROM v_job_log WHERE status = 'failed')"""),
    "delivery_order": _with(
        "SELECT message_id, queue_type, row_number() OVER (PARTITION BY queue_type "
        "ORDER BY priority DESC, published_at, message_id) AS delivery_position FROM v_messages"
    ),
    "page": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000",
    "latest_archive": _with(_LATEST_ARCHIVE.format(source="v_archive")),
    "find_by_batch": _with("SELECT * FROM v_archive WHERE archive_batch = 'someModel_batch_3'"),
    "allocate_sequence": """
SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name) + (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS seq
FROM customer""",
    "allocate_sequence_counters": """
SELECT o_orderstatus AS name, count(*) + CASE WHEN o_orderstatus = 'F' THEN (SELECT count(*) FROM customer) ELSE 0 END AS seq
FROM orders GROUP BY o_orderstatus""",
    "work_order": _with(
        "SELECT item_id, CASE status WHEN 'pending' THEN 1 WHEN 'processing' THEN 2 ELSE 3 END AS work_rank, created_at "
        "FROM v_items WHERE status <> 'success' ORDER BY work_rank, created_at, item_id"
    ),
    "stream_handler": _with(
        "SELECT message_id, outcome, CAST(CASE WHEN outcome = 'retry' THEN x_retries + 1 WHEN outcome <> 'ok' THEN x_retries ELSE -1 END AS BIGINT) AS next_retries, "
        "CASE outcome WHEN 'retry' THEN routing_key WHEN 'dead_letter' THEN dead_key END AS next_key FROM split",
        {"handled": "SELECT * REPLACE (handler_failed OR x_retries > 5 AS handler_failed) FROM v_messages",
         "judged": _JUDGED.format(source="handled"), "split": _SPLIT},
    ),
    "retry_policy": _with(
        f"SELECT message_id, queue_type, {_OUTCOME} AS outcome, CAST(CASE WHEN again THEN x_retries + 1 ELSE x_retries END AS BIGINT) AS next_retries, "
        "CASE WHEN again THEN published_at + to_milliseconds(delay_ms) END AS expires_at, "
        "CASE WHEN again THEN routing_key ELSE dead_key END AS next_key FROM judged WHERE handler_failed",
        {"judged": _JUDGED.format(source="v_messages")},
    ),
    "split_outcomes": _with(f"""
SELECT message_id, outcome, CAST(CASE WHEN outcome = 'retry' THEN x_retries + 1 WHEN outcome <> 'ok' THEN x_retries ELSE -1 END AS BIGINT) AS next_retries,
  CASE WHEN outcome = 'retry' THEN published_at + to_milliseconds(delay_ms) END AS expires_at,
  CASE outcome WHEN 'retry' THEN routing_key WHEN 'dead_letter' THEN dead_key END AS next_key,
  CASE WHEN outcome = 'dead_letter' THEN 'handler failed' END AS x_death_reason,
  CASE WHEN outcome = 'dead_letter' THEN {AS_OF} END AS x_death_at,
  CASE WHEN outcome = 'dead_letter' THEN routing_key END AS x_original_routing_key,
  CASE WHEN outcome = 'dead_letter' THEN queue_name END AS x_first_death_queue,
  CASE WHEN outcome = 'dead_letter' THEN x_retries + 1 ELSE -1 END AS x_death_count FROM split""",
        {"judged": _JUDGED.format(source="v_messages"), "split": _SPLIT}),
    "requeue": _with(f"""
SELECT message_id, correlation_id, queue_type, routing_key, priority, CAST(x_retries + 1 AS BIGINT) AS x_retries,
  published_at + to_milliseconds(delay_ms) AS expires_at, queue_name AS x_original_queue,
  'handler failed' AS x_retry_reason, {AS_OF} AS x_retry_at FROM split WHERE outcome = 'retry'""",
        {"judged": _JUDGED.format(source="v_messages"), "split": _SPLIT}),
    # Retried until the limit: the count ends at the limit, or stays where it was beyond it.
    "outcome_counts": _with(
        "SELECT queue_type, outcome, count(*) AS messages FROM split GROUP BY queue_type, outcome",
        {"judged": _JUDGED.format(source="v_messages"), "split": _SPLIT},
    ),
    "expire_messages": _with("""
SELECT message_id, queue_type, fate, CASE WHEN fate = 'dead_letter' THEN expired_key END AS expired_key,
  CASE WHEN fate = 'dead_letter' THEN 'app.deadletter.exchange' END AS expired_exchange
FROM (SELECT m.*, p.expired_key, CASE WHEN NOT (ttl_ms > 0 AND wait_ms > ttl_ms) THEN 'waiting'
  WHEN p.expired_key IS NOT NULL THEN 'dead_letter' ELSE 'dropped' END AS fate
  FROM v_messages m LEFT JOIN policy p ON m.queue_type = p.queue_type)"""),
    "job_status_stream": _with("SELECT correlation_id, event_ts, seq, status FROM latest", {"latest": _LATEST_JOB}),
    "processing_timeout": _with(
        _late(f"coalesce(next_ts, {AS_OF}) > event_ts + INTERVAL 300 SECOND"), {"entries": _NEXT_ENTRY}
    ),
    "processing_timeout_stream": _with(
        _late(f"coalesce(next_ts, {AS_OF}) > event_ts + INTERVAL 300 SECOND"), {"entries": _NEXT_ENTRY}
    ),
    "processing_timeout_priority": _with(
        "SELECT correlation_id, seq, 'Priority worker timeout exceeded' AS message FROM ("
        + _late(f"coalesce(next_ts, {AS_OF}) > event_ts + INTERVAL 300 SECOND") + ")", {"entries": _NEXT_ENTRY}
    ),
    "make_batches_text_key": """
SELECT 'pages_batch_' || batch_number AS batch_id, count(*) AS items, min(page) AS first_page
FROM (SELECT page, (row_number() OVER (ORDER BY page) - 1) // 100 + 1 AS batch_number
  FROM (SELECT url || '#' || page_id AS page FROM pages)) GROUP BY batch_number""",
    "dead_letter_triage": _with(f"""
SELECT message_id, deaths, CASE WHEN message_id % 3 = 0 THEN 'unknown' ELSE 'app.processing.queue' END AS origin,
  {_TRIAGE} AS action, CAST(CASE WHEN deaths < 3 THEN 5000 * deaths ELSE -1 END AS BIGINT) AS requeue_delay_ms
FROM (SELECT *, coalesce(death_count, 1) AS deaths FROM v_messages WHERE queue_type = 'deadletter')"""),
    "archive_stream": _with(
        f"SELECT item_id AS original_id, status, 'someModel_batch_' || batch_number AS archive_batch, {AS_OF} AS archived_at, "
        "'archive-worker' AS archived_by, updated_at AS original_updated_at FROM batched", {"batched": _BATCHED}
    ),
    "archive_stream_once": _with(
        f"SELECT item_id AS original_id, status, 'someModel_batch_' || batch_number AS archive_batch, {AS_OF} AS archived_at, "
        "'archive-worker' AS archived_by, updated_at AS original_updated_at FROM batched", {"batched": _BATCHED}
    ),
    "archive_stream_errors": _with("""
SELECT correlation_id, error, count(*) AS items FROM (SELECT 'someModel_batch_' || batch_number AS correlation_id,
  CASE item_id % 10 WHEN 7 THEN 'item does not fit its fields' WHEN 3 THEN 'name is required' ELSE 'archived' END AS error
  FROM batched) GROUP BY ALL""", {"batched": _BATCHED}),
    "bulk_update_stream_priority": _with(
        "SELECT 'someModel_batch_' || batch_number AS correlation_id, 'completed' AS status, 100.0::DOUBLE AS progress, "
        "count(*) AS processed_items, 'Successfully processed ' || count(*) || ' high-priority items in worker thread' AS message, "
        "'priority-consumer' AS processed_by FROM batched GROUP BY batch_number", {"batched": _BATCHED}
    ),
    "bulk_update_stream": _with(
        "SELECT " + _transition("'someModel_batch_' || batch_number") + " FROM batched i", {"batched": _BATCHED}
    ),
    "bulk_update_stream_jobs": _with(
        "SELECT 'someModel_batch_' || batch_number AS correlation_id, 'completed' AS status, 100.0::DOUBLE AS progress, "
        "count(*) AS processed_items, 'Successfully processed ' || count(*) || ' items in worker thread' AS message "
        "FROM batched GROUP BY batch_number UNION ALL "
        "SELECT 'someModel_batch_' || batch_number, 'processing', NULL, -1, 'Processing ' || count(*) || ' items in worker thread' "
        "FROM batched GROUP BY batch_number", {"batched": _BATCHED}
    ),
    "throughput": _with("""
SELECT time_bucket(INTERVAL 1 HOUR, published_at) AS window_start, time_bucket(INTERVAL 1 HOUR, published_at) + INTERVAL 1 HOUR AS window_end,
  queue_type, count(*) AS messages FROM v_messages GROUP BY ALL"""),
    "throughput_stream": _with("""
SELECT date_trunc('day', published_at)::TIMESTAMP AS window_start,
  date_trunc('day', published_at)::TIMESTAMP + INTERVAL 1 DAY AS window_end, queue_type, count(*) AS messages
FROM v_messages GROUP BY ALL"""),
    "stream_activity": _with("""
SELECT worker_no, consumer_type, count(*) AS messages, count(*) FILTER (handler_failed)::BIGINT AS errors, true AS timed, 'exit' AS last
FROM v_messages JOIN (VALUES ('processing', 0, 'ProcessingConsumer'), ('priority', 1, 'PriorityConsumer'),
  ('archive', 2, 'ArchiveConsumer')) c(queue_type, worker_no, consumer_type) USING (queue_type) GROUP BY ALL"""),
    "throughput_late": _with("""
SELECT date_trunc('day', published_at)::TIMESTAMP AS window_start, date_trunc('day', published_at)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
  queue_type, count(*) FILTER (NOT late) AS on_time, count(*) FILTER (late) AS late
FROM (SELECT m.*, coalesce(date_trunc('day', published_at)::TIMESTAMP + INTERVAL 1 DAY <= mark, false) AS late
  FROM v_messages m JOIN marked ON message_id % 4 = s) GROUP BY ALL""", {
        "latest": "SELECT message_id % 4 AS s, max(published_at) AS latest FROM v_messages GROUP BY ALL",
        "marked": "SELECT a.s, max(b.latest) - INTERVAL 10 DAY AS mark FROM latest a LEFT JOIN latest b ON b.s < a.s GROUP BY a.s"}),
    "archive_flow": _with(_BATCH_COUNTS, {"batched": _BATCHED}),
    "archive_flow_missing": _with("SELECT item_id FROM v_items WHERE false"),
    "bulk_update_flow": _with(
        "SELECT " + _transition("'someModel_batch_' || batch_number") + " FROM batched i UNION ALL "
        f"SELECT {_KEPT} FROM v_items i WHERE status NOT IN ('pending', 'failed')",
        {"batched": _BATCHED + " WHERE status IN ('pending', 'failed')"},
    ),
    "bulk_update_flow_stats": _with(
        "SELECT count(*) AS processed, count(*) AS matched, count(*) AS modified FROM v_items WHERE status IN ('pending', 'failed')"
    ),
    "failure_flow": _with(
        "SELECT queue_type, outcome, count(*) AS messages FROM split GROUP BY queue_type, outcome",
        {"handled": "SELECT * REPLACE (handler_failed OR message_id % 7 = 0 AS handler_failed) FROM v_messages",
         "judged": _JUDGED.format(source="handled"), "split": _SPLIT},
    ),
    "failure_flow_triage": _with(f"""
SELECT message_id, deaths, queue_name AS origin, {_TRIAGE} AS action,
  CAST(CASE WHEN deaths < 3 THEN 5000 * deaths ELSE -1 END AS BIGINT) AS requeue_delay_ms,
  CASE WHEN message_id % 7 = 0 THEN 'undecodable body' ELSE 'handler failed' END AS x_death_reason
FROM (SELECT *, x_retries + 1 AS deaths FROM split WHERE outcome = 'dead_letter')""",
        {"handled": "SELECT * REPLACE (handler_failed OR message_id % 7 = 0 AS handler_failed) FROM v_messages",
         "judged": _JUDGED.format(source="handled"), "split": _SPLIT}),
    "failure_flow_jobs": _with("""
SELECT correlation_id, status, message, count(*) AS entries FROM (SELECT correlation_id, status, NULL AS message FROM known
  UNION ALL SELECT correlation_id, step, CASE step WHEN 'dead_letter_completed'
      THEN 'Dead letter processing completed for 1 items (deaths: ' || (x_retries + 1) || ')'
      ELSE 'Processing 1 dead letter items (deaths: ' || (x_retries + 1) || ') in worker thread' END
    FROM split, (SELECT unnest(['dead_letter_processing', 'dead_letter_completed']) AS step)
    WHERE outcome = 'dead_letter' AND message_id % 3 <> 0 AND correlation_id IN (SELECT correlation_id FROM known)) GROUP BY ALL""",
        {"known": "SELECT * FROM v_job_log",
         "handled": "SELECT * REPLACE (handler_failed OR message_id % 7 = 0 AS handler_failed) FROM v_messages",
         "judged": _JUDGED.format(source="handled"), "split": _SPLIT}),
    "status_overview": _with("SELECT status, count(*) AS items, max(updated_at) AS last_updated FROM v_items GROUP BY status"),
}
# Streams that must come to the rows of the batch operators.
ORACLES |= {f"{name}_stream": ORACLES[name] for name in ("dead_letter_jobs", "job_progress")}
