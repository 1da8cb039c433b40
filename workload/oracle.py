"""The registered queries in plain SQL over the given tables, for an independent engine."""

from __future__ import annotations

# Fixed values, equal to those of workload.tables.
MID_AT, MID_PK = "TIMESTAMP '1998-06-15'", 9699
CUT = "TIMESTAMP '2024-01-16 12:00:00'"


def iso(ts: str) -> str:
    return (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
        f"ELSE '.' || lpad(CAST(((epoch_us({ts}) % 1000000) + 1000000) % 1000000 AS VARCHAR), 6, '0') END || 'Z')"
    )


def day(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d')"


def text(expr: str) -> str:
    """A JSON string literal, or null."""
    return f"coalesce(CAST(to_json(CAST({expr} AS VARCHAR)) AS VARCHAR), 'null')"


TOTAL = "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)"
O = (
    "(SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, "
    f"o_orderpriority AS priority, {TOTAL} AS total, o_orderdate AS moment FROM orders)"
)
E_ = "(SELECT event_id, user_id, event_type, props, ts AS moment FROM events)"
O_COLUMNS = f"order_id, customer_id, status, priority, total, {iso('moment')} AS updated_at"
E_COLUMNS = f"event_id, user_id, event_type, props, {iso('moment')} AS updated_at"
# No event has key 0 at the cut itself, so the instant alone decides.
PAST_MID = f"(moment, order_id) > ({MID_AT}, {MID_PK})"
UPTO_MID = f"(moment, order_id) <= ({MID_AT}, {MID_PK})"

ORDER_RECORD = (
    f"'{{\"customer_id\":' || customer_id || ',\"order_id\":' || order_id || ',\"priority\":' || {text('priority')} || "
    f"',\"status\":' || {text('status')} || ',\"total\":\"' || total || '\",\"updated_at\":\"' || {iso('moment')} || '\"}}'"
)
EVENT_RECORD = (
    f"'{{\"event_id\":' || event_id || ',\"event_type\":' || {text('event_type')} || ',\"props\":' || {text('props')} || "
    f"',\"updated_at\":\"' || {iso('moment')} || '\",\"user_id\":' || user_id || '}}'"
)

ORDERS_SHAPE = (
    '{"columns":[{"name":"order_id","type":"bigint"},{"name":"customer_id","type":"bigint"},'
    '{"name":"status","type":"text"},{"name":"priority","type":"text"},'
    '{"name":"total","type":"numeric(15,2)"},{"name":"updated_at","type":"timestamptz"}],"table":"orders"}'
)
EVENTS_COLUMNS_SHAPE = (
    '{"name":"event_id","type":"bigint"},{"name":"user_id","type":"bigint"},{"name":"event_type","type":"text"},'
    '{"name":"props","type":"text"},{"name":"updated_at","type":"timestamptz"}'
)
EVENTS_SHAPE = f'{{"columns":[{EVENTS_COLUMNS_SHAPE}],"table":"events"}}'
LESS_SHAPE = EVENTS_SHAPE.replace('{"name":"props","type":"text"},', "")
WIDER_SHAPE = f'{{"columns":[{EVENTS_COLUMNS_SHAPE},{{"name":"value","type":"double precision"}}],"table":"events"}}'


def fingerprint(shape: str) -> str:
    return f"substr(sha256('{shape}'), 1, 16)"


def identity(table: str, pk: str, at: str) -> str:
    return f"'{{\"pk\":' || {pk} || ',\"table\":\"{table}\",\"updated_at\":\"' || {iso(at)} || '\"}}'"


def lanes(hash_column: str) -> str:
    return ", ".join(
        f"CAST(sum(CAST(CAST('0x' || substr({hash_column}, {1 + 15 * k}, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS lane{k}"
        for k in range(4)
    )


def digest(table: str, pk: str, rows: str) -> str:
    """Count, last position and lanes of a delta; ``rows`` yields ``moment`` and the key."""
    return (
        f"SELECT '{table}' AS table_name, count(*) AS delta_row_count, {iso('max(moment)')} AS last_at, "
        f"arg_max({pk}, (moment, {pk})) AS last_pk, {lanes('h')} "
        f"FROM (SELECT moment, {pk}, sha256({identity(table, pk, 'moment')}) AS h FROM {rows})"
    )


ORDERS_DIGEST = digest("orders", "order_id", f"{O} WHERE {PAST_MID}")
EVENTS_DIGEST = digest("events", "event_id", E_)
LANE_LIST = "'[\"' || lane0 || '\",\"' || lane1 || '\",\"' || lane2 || '\",\"' || lane3 || '\"]'"
MID_MARK = '{"last_pk":9699,"updated_at":"1998-06-15T00:00:00Z"}'
EMPTY_MARK = '{"last_pk":0,"updated_at":"0001-01-01T00:00:00Z"}'


def run_id(before: str, *digests: str) -> str:
    """The run id as a scalar; ``digests`` are sub-queries in table-name order."""
    tables = " || ',' || ".join(
        f"(SELECT '\"' || table_name || '\":{{\"lanes\":' || {LANE_LIST} || ',\"rows\":' || delta_row_count || '}}' FROM ({d}))"
        for d in digests
    )
    return (
        f"substr(sha256('{{\"checkpoint_before\":{before},\"scheme\":\"lanes-1\",\"tables\":{{' || {tables} || '}}}}'), 1, 32)"
    )


BOTH_RUN_ID = run_id(f'{{"events":{EMPTY_MARK},"orders":{MID_MARK}}}', EVENTS_DIGEST, ORDERS_DIGEST)
ORDERS_RUN_ID = run_id(f'{{"orders":{MID_MARK}}}', ORDERS_DIGEST)

LAST_ORDER = (
    "SELECT '{\"orders\":{\"last_pk\":' || last_pk || ',\"updated_at\":\"' || last_at || '\"}}' AS after "
    f"FROM ({ORDERS_DIGEST})"
)
ALL_EVENTS = f"SELECT {E_COLUMNS} FROM {E_}"
KEYWORDS = "['billing','audit','compliance','payments','reconciliation','onboarding','fraud','AML']"
STATUSES = "['open','in_review','resolved','closed','pending','escalated']"
COUNTRIES = "['US','CA','GB','DE','AU']"
DAMAGED = (
    "(SELECT order_id AS row_id, CASE WHEN priority = '1-URGENT' THEN -order_id - 1 "
    "WHEN priority <> '2-HIGH' THEN order_id END AS order_id, customer_id, status, priority, total, "
    f"CASE WHEN status <> 'P' THEN moment END AS moment FROM {O})"
)
REASON = (
    "CASE WHEN moment IS NULL THEN 'updated_at is missing' WHEN order_id IS NULL THEN 'key is missing' "
    "WHEN order_id < 0 THEN 'key is negative' END"
)
NEW_ORDERS = f"SELECT order_id + 1000000000 AS order_id, customer_id, status, priority, total, moment FROM {O} WHERE priority = '1-URGENT'"
LAGS = (
    "(SELECT 'events' AS table_name, CAST((epoch_us(ts) // 1000000 // 120 + 1) * 120 - epoch_us(ts) // 1000000 AS BIGINT) AS lag FROM events "
    "UNION ALL SELECT 'orders', 86400 + o_custkey % 7000 FROM orders)"
)


def run_event(n: str, count: str, parts: str, at: str, pk: str, table: str, share: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, CAST({count} AS BIGINT) AS delta_row_count, "
        f"{fingerprint(EVENTS_SHAPE if table == 'events' else ORDERS_SHAPE)} AS schema_fingerprint, "
        f"CAST({parts} AS BIGINT) AS partitions, {share} AS has_share, {at} AS events_at, CAST({pk} AS BIGINT) AS events_pk "
        f"FROM {n}"
    )


FIRST = f"(SELECT count(*) AS n, count(DISTINCT {day('ts')}) AS d, {iso('max(ts)')} AS a, arg_max(event_id, ts) AS p FROM events WHERE ts <= {CUT})"
SECOND = f"(SELECT count(*) AS n, count(DISTINCT {day('ts')}) AS d, {iso('max(ts)')} AS a, arg_max(event_id, ts) AS p FROM events WHERE ts > {CUT})"

ORACLE: dict[str, str] = {
    "delta_scan": f"SELECT {E_COLUMNS}, row_number() OVER (ORDER BY moment, event_id) AS row_number FROM {E_} WHERE moment > {CUT}",
    "delta_mid_tie": f"SELECT {O_COLUMNS} FROM {O} WHERE {PAST_MID}",
    "delta_initial": f"SELECT {O_COLUMNS} FROM {O}",
    "checkpoint_default": (
        "SELECT 'orders' AS table_name, '1998-06-15T00:00:00Z' AS updated_at, CAST(9699 AS BIGINT) AS last_pk, "
        f"count(*) AS delta_row_count FROM {O} WHERE {PAST_MID} "
        "UNION ALL SELECT 'events', '0001-01-01T00:00:00Z', CAST(0 AS BIGINT), count(*) FROM events"
    ),
    "row_identities": f"SELECT order_id AS pk, 'orders' AS table_name, {iso('moment')} AS updated_at FROM {O} WHERE {PAST_MID}",
    "iso_utc": (
        f"SELECT event_id, {iso('ts')} AS moment, {iso('date_trunc(' + chr(39) + 'second' + chr(39) + ', ts)')} AS whole_second, "
        f"{iso('make_timestamp(-epoch_us(ts))')} AS before_1970 FROM events"
    ),
    "iso_roundtrip": (
        "SELECT event_id, epoch_us(ts) AS micros, epoch_us(ts) // 1000000 - 18000 AS offset_seconds, "
        "epoch_us(ts) // 1000000 AS bare_seconds FROM events"
    ),
    "canonical_json": f"SELECT event_id, {EVENT_RECORD} AS line FROM {E_}",
    "type_encodings": (
        f"SELECT order_id, '{{\"amounts\":[\"' || total || '\",null],\"day\":\"' || {day('moment')} || '\",\"gap\":' || "
        f"{text('CASE WHEN status <> ' + chr(39) + 'P' + chr(39) + ' THEN status END')} || ',\"nested\":{{\"a\":\"' || {iso('moment')} || "
        f"'\",\"z\":' || {text('status')} || '}},\"order_id\":' || order_id || ',\"raw\":' || {text('priority')} || "
        f"',\"total\":\"' || total || '\"}}' AS line FROM {O}"
    ),
    "checkpoint_map": (
        # Upper-case statuses sort before the table name.
        f"SELECT order_id, '{{\"marks\":{{' || {text('status')} || ':{{\"last_pk\":' || order_id || ',\"updated_at\":\"' || {iso('moment')} || "
        f"'\"}},\"customers\":{{\"last_pk\":' || order_id || ',\"updated_at\":\"' || {iso('moment')} || '\"}}}}}}' AS text FROM {O}"
    ),
    "row_hash": f"SELECT order_id, substr(sha256({ORDER_RECORD}), 1, 16) AS hash FROM {O}",
    "seed_shape": (
        "SELECT order_id, 'Case ' || CASE WHEN length(CAST(i AS VARCHAR)) > 4 THEN substr(CAST(i AS VARCHAR), 1, 4) "
        "ELSE lpad(CAST(i AS VARCHAR), 4, '0') END || ' - ' || upper(substr(k, 1, 1)) || lower(substr(k, 2)) || ' review' AS title, "
        f"{STATUSES}[(i - 1) % 6 + 1] AS status, {COUNTRIES}[(i - 1) % 5 + 1] AS country, "
        f"{iso('(TIMESTAMP ' + chr(39) + '2026-03-01' + chr(39) + ' + to_seconds(((i - 1) % 100) * 25920))')} AS moment "
        f"FROM (SELECT o_orderkey AS order_id, o_orderkey + 1 AS i, {KEYWORDS}[o_orderkey % 8 + 1] AS k FROM orders)"
    ),
    "delta_counts": (
        "SELECT 'orders' AS table_name, count(*) AS delta_row_count FROM orders WHERE o_orderdate > TIMESTAMP '2002-01-01' "
        f"UNION ALL SELECT 'events', count(*) FROM events WHERE ts > {CUT}"
    ),
    "checkpoint_advance": (
        "SELECT 'orders' AS table_name, '2002-01-01T00:00:00Z' AS updated_at, CAST(0 AS BIGINT) AS last_pk FROM orders "
        "GROUP BY ALL HAVING max(o_orderdate) <= TIMESTAMP '2002-01-01' UNION ALL "
        f"SELECT 'events', {iso('max(ts)')}, arg_max(event_id, (ts, event_id)) FROM events WHERE ts > {CUT}"
    ),
    "touched_partitions": (
        "SELECT *, row_number() OVER (ORDER BY table_ordinal, date) AS position FROM ("
        f"SELECT DISTINCT CAST(0 AS INTEGER) AS table_ordinal, 'orders' AS table_name, {day('moment')} AS date FROM {O} WHERE {PAST_MID} "
        f"UNION ALL SELECT DISTINCT CAST(1 AS INTEGER), 'events', {day('ts')} FROM events)"
    ),
    "partition_counts": (
        f"SELECT 'orders' AS table_name, {day('moment')} AS date, count(*) AS row_count FROM {O} WHERE {PAST_MID} GROUP BY ALL "
        f"UNION ALL SELECT 'events', {day('ts')}, count(*) FROM events GROUP BY ALL"
    ),
    "run_digest": f"{ORDERS_DIGEST} UNION ALL {EVENTS_DIGEST}",
    "schema_fingerprint": (
        f"SELECT 'orders' AS table_name, {fingerprint(ORDERS_SHAPE)} AS schema_fingerprint, count(*) AS row_count FROM {O} WHERE {PAST_MID} "
        f"UNION ALL SELECT 'events', {fingerprint(EVENTS_SHAPE)}, count(*) FROM events"
    ),
    "share_batch": (
        f"SELECT order_id, '{{\"checkpoint_after\":' || after || ',\"op\":\"upsert\",\"order_id\":' || order_id || ',\"record\":' || "
        f"{ORDER_RECORD} || ',\"run_id\":\"' || run_id || '\",\"schema_fingerprint\":\"' || {fingerprint(ORDERS_SHAPE)} || "
        f"'\",\"table\":\"orders\",\"updated_at\":\"' || {iso('moment')} || '\"}}' AS line "
        f"FROM {O}, ({LAST_ORDER}), (SELECT {ORDERS_RUN_ID} AS run_id) WHERE {PAST_MID}"
    ),
    "dry_run_manifest": (
        f"SELECT t.table_name, delta_row_count, schema_fingerprint, {BOTH_RUN_ID} AS run_id, partitions, first_date, last_date, true AS has_share "
        f"FROM (SELECT 'orders' AS table_name, count(*) AS delta_row_count, {fingerprint(ORDERS_SHAPE)} AS schema_fingerprint, "
        f"count(DISTINCT {day('moment')}) AS partitions, min({day('moment')}) AS first_date, max({day('moment')}) AS last_date FROM {O} WHERE {PAST_MID} "
        f"UNION ALL SELECT 'events', count(*), {fingerprint(EVENTS_SHAPE)}, count(DISTINCT {day('ts')}), min({day('ts')}), max({day('ts')}) FROM events) t"
    ),
    "run_events": " UNION ALL ".join(
        [
            run_event(FIRST, "n", "d", "a", "p", "events", "true"),
            run_event(FIRST, "0", "0", "a", "p", "orders", "false"),
            run_event(SECOND, "n", "d", "a", "p", "events", "true"),
            run_event(SECOND, "0", "0", "a", "p", "orders", "false"),
            run_event(SECOND, "0", "0", "a", "p", "events", "false"),
            run_event(SECOND, "0", "0", "a", "p", "orders", "false"),
        ]
    ),
    "lake_after_two_runs": f"SELECT {E_COLUMNS}, CAST(CASE WHEN moment <= {CUT} THEN 1 ELSE 2 END AS BIGINT) AS run_no FROM {E_}",
    "lake_range_scan": f"SELECT {E_COLUMNS} FROM {E_} WHERE moment >= TIMESTAMP '2024-01-15' AND moment < TIMESTAMP '2024-01-18'",
    "committed_lake": f"SELECT {E_COLUMNS} FROM {E_} WHERE moment <= {CUT}",
    "recovered_lake": ALL_EVENTS,
    "share_replace": (
        f"SELECT 'events' AS table_name, 'upsert' AS op, event_id, {iso('moment')} AS updated_at, {fingerprint(EVENTS_SHAPE)} AS schema_fingerprint, "
        f"(SELECT arg_max(event_id, (ts, event_id)) FROM events) AS after_pk, user_id, props FROM {E_} WHERE moment > {CUT}"
    ),
    "compacted_lake": f"SELECT {E_COLUMNS}, {day('moment')} = '2024-01-16' AS compacted FROM {E_}",
    "retained_lake": ALL_EVENTS,
    "time_travel": (
        f"SELECT user_id, event_id, event_type, {iso('moment')} AS updated_at FROM {E_} WHERE moment <= {CUT} "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY moment DESC) = 1"
    ),
    "columnar_lake": ALL_EVENTS,
    "stream_drain": ALL_EVENTS,
    "stream_drain_many": ALL_EVENTS,
    "stream_resume": ALL_EVENTS,
    "changes_since": f"SELECT {O_COLUMNS} FROM (SELECT * FROM {O} WHERE {PAST_MID} ORDER BY moment, order_id LIMIT 500)",
    "changes_since_lake": f"SELECT {E_COLUMNS} FROM (SELECT * FROM {E_} WHERE moment > {CUT} ORDER BY moment, event_id LIMIT 200)",
    "as_of_state": (
        f"SELECT user_id, event_id, event_type, {iso('moment')} AS updated_at FROM {E_} WHERE moment <= {CUT} "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY moment DESC) = 1"
    ),
    "apply_changes": (
        f"SELECT {O_COLUMNS} FROM (SELECT order_id, customer_id, CASE WHEN status = 'P' THEN 'F' ELSE status END AS status, priority, total, "
        f"CASE WHEN status = 'P' THEN moment + INTERVAL 1 DAY ELSE moment END AS moment FROM {O} UNION ALL {NEW_ORDERS})"
    ),
    "merge_with_deletes": (
        f"SELECT {O_COLUMNS} FROM (SELECT order_id, customer_id, 'F' AS status, priority, total, moment FROM {O} WHERE status <> 'O' "
        f"UNION ALL {NEW_ORDERS})"
    ),
    "cdc_dedupe": "SELECT 'events' AS table_name, event_id, epoch_us(ts) AS lsn, event_type FROM events",
    "cdc_dedupe_stream": "SELECT 'events' AS table_name, event_id, epoch_us(ts) AS lsn, event_type FROM events",
    "cdc_dedupe_late": "SELECT 'events' AS table_name, event_id, epoch_us(ts) AS lsn, event_type FROM events",
    "cdc_exact": "SELECT 'events' AS table_name, event_id, epoch_us(ts) AS lsn, event_type FROM events",
    "stream_drain_repeats": f"SELECT {E_COLUMNS} FROM {E_}",
    "validity": (
        f"SELECT user_id, event_id, event_type, {iso('ts')} AS updated_at, {iso('ts')} AS valid_from, {iso('later')} AS valid_to "
        "FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS later FROM events)"
    ),
    "point_in_time": (
        "WITH p AS (SELECT user_id, event_id AS probe, ts - to_microseconds(back) AS moment FROM events, (SELECT unnest([0, 1]) AS back) WHERE event_type = 'purchase'), "
        "v AS (SELECT p.user_id, p.probe, p.moment, e.event_id, e.event_type, row_number() OVER (PARTITION BY p.user_id, p.probe, p.moment ORDER BY e.ts DESC) AS r "
        "FROM p LEFT JOIN events e ON e.user_id = p.user_id AND e.ts <= p.moment) "
        f"SELECT user_id, probe, {iso('moment')} AS at, event_id AS version_event_id, event_type AS version_event_type FROM v WHERE r = 1"
    ),
    "cursor_pages": (
        "WITH n AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS r FROM events), "
        "c AS (SELECT user_id, min(r) AS r FROM n JOIN events USING (event_id) WHERE event_type = 'view' GROUP BY user_id) "
        f"SELECT c.user_id AS consumer, CAST(n.r - c.r AS INTEGER) AS position, n.event_id, {iso('n.ts')} AS updated_at FROM c JOIN n ON n.r > c.r AND n.r <= c.r + 20"
    ),
    "lake_deletes": (
        f"SELECT {E_COLUMNS}, 'upsert' AS op FROM {E_} UNION ALL "
        f"SELECT event_id, NULL, NULL, NULL, {iso('moment')}, 'delete' FROM {E_} WHERE event_type = 'purchase'"
    ),
    "deletes_as_of": f"SELECT {E_COLUMNS}, 'upsert' AS op FROM {E_} WHERE event_type <> 'purchase'",
    "snapshot_diff_tree": (
        f"WITH e AS (SELECT * FROM {O}), a AS (SELECT order_id, customer_id, CASE WHEN order_id % 100000 < 300 THEN 'X' ELSE status END AS status, "
        f"priority, total, moment FROM {O} WHERE NOT (order_id % 100000 < 300 AND status = 'O')) "
        f"SELECT {O_COLUMNS}, 'expected' AS only_in, CAST(count(*) AS BIGINT) AS copies FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a) GROUP BY ALL "
        f"UNION ALL SELECT {O_COLUMNS}, 'actual', CAST(count(*) AS BIGINT) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e) GROUP BY ALL"
    ),
    "late_rows": f"SELECT {O_COLUMNS} FROM {O} WHERE {UPTO_MID} AND priority = '1-URGENT'",
    "invalid_rows": f"SELECT row_id, {REASON} AS reason FROM {DAMAGED} WHERE {REASON} IS NOT NULL",
    "quarantine_split": f"SELECT row_id, CASE WHEN {REASON} IS NULL THEN 'good' ELSE 'quarantine' END AS target FROM {DAMAGED}",
    "sync_quarantine": (
        "SELECT event_id AS row_id, CASE WHEN user_id % 7 = 0 THEN 'updated_at is missing' WHEN user_id % 5 = 1 THEN 'key is missing' "
        "WHEN user_id % 5 = 0 THEN 'key is negative' END AS reason FROM events"
    ),
    "readmitted_rows": (
        "SELECT event_id AS row_id, coalesce(reason, 'published') AS state, CASE WHEN reason IS NOT NULL THEN CAST(1 AS BIGINT) END AS copies, "
        "CASE WHEN reason IS NULL THEN NULL WHEN user_id % 7 = 0 OR ts <= " + CUT + " THEN '2024-03-01T00:00:00Z' ELSE '2024-03-02T00:00:00Z' END AS first_seen, "
        "CASE WHEN reason IS NOT NULL THEN '2024-03-05T00:00:00Z' END AS last_seen FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN NULL "
        "WHEN user_id % 7 = 0 THEN 'updated_at is missing' WHEN user_id % 5 = 1 THEN 'key is missing' WHEN user_id % 5 = 0 THEN 'key is negative' END AS reason FROM events)"
    ),
    "schema_gate": (
        f"SELECT {fingerprint(EVENTS_SHAPE)} AS schema_fingerprint, 'published' AS decision, count(*) AS row_count FROM events WHERE ts <= {CUT} "
        f"UNION ALL SELECT {fingerprint(WIDER_SHAPE)}, 'published', count(*) FROM events WHERE ts > {CUT} "
        f"UNION ALL SELECT {fingerprint(LESS_SHAPE)}, 'refused', CAST(0 AS BIGINT)"
    ),
    "schema_diff": (
        f"SELECT 'order_id' AS column_name, 'same' AS change, false AS breaking, count(order_id) AS values_present FROM {DAMAGED} "
        f"UNION ALL SELECT 'customer_id', 'retyped', true, count(customer_id) FROM {DAMAGED} "
        f"UNION ALL SELECT 'status', 'same', false, count(status) FROM {DAMAGED} "
        f"UNION ALL SELECT 'priority', 'dropped', true, count(priority) FROM {DAMAGED} "
        f"UNION ALL SELECT 'total', 'same', false, count(total) FROM {DAMAGED} "
        f"UNION ALL SELECT 'currency', 'added', false, CAST(0 AS BIGINT) "
        f"UNION ALL SELECT 'updated_at', 'same', false, count(moment) FROM {DAMAGED}"
    ),
    "fingerprint_gate": (
        f"SELECT {fingerprint(EVENTS_SHAPE)} AS schema_fingerprint, count(*) AS row_count, true AS accepted FROM events WHERE ts <= {CUT} "
        f"UNION ALL SELECT {fingerprint(WIDER_SHAPE)}, count(*), false FROM events WHERE ts > {CUT}"
    ),
    "freshness": (
        "SELECT table_name, row_count, lag AS lag_seconds FROM (SELECT table_name, lag, "
        "row_number() OVER (PARTITION BY table_name ORDER BY lag) AS r, count(*) OVER (PARTITION BY table_name) AS row_count "
        f"FROM {LAGS}) WHERE r = CAST(ceil(row_count * 0.95) AS BIGINT)"
    ),
    "freshness_lake": (
        "SELECT 'events' AS table_name, row_count, lag AS lag_seconds FROM (SELECT lag, row_number() OVER (ORDER BY lag) AS r, count(*) OVER () AS row_count "
        f"FROM (SELECT epoch_us(CASE WHEN ts <= {CUT} THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-03-01 01:00:00' END) // 1000000 "
        "- epoch_us(ts) // 1000000 AS lag FROM events)) WHERE r = CAST(ceil(row_count * 0.95) AS BIGINT)"
    ),
    "stale_cursors": (
        f"SELECT user_id, {iso('c')} AS cursor_at, epoch_us(m) // 1000000 - epoch_us(c) // 1000000 AS lag_seconds "
        "FROM (SELECT user_id, max(ts) AS c FROM events WHERE event_type = 'view' GROUP BY user_id), "
        "(SELECT max(ts) AS m FROM events) WHERE epoch_us(m) // 1000000 - epoch_us(c) // 1000000 > 86400"
    ),
    "stale_alarms": (
        f"WITH v AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS following, epoch_us(max(ts) OVER ()) // 1000 - 43200000 AS clock "
        f"FROM events WHERE event_type = 'view') SELECT user_id, {iso('ts')} AS last_progress, {iso("(ts + INTERVAL 1 DAY)")} AS raised_at, "
        f"CASE WHEN (epoch_us(following) + 999) // 1000 <= clock THEN {iso('following')} END AS cleared_at FROM v "
        "WHERE (epoch_us(ts) + 86400000999) // 1000 <= clock AND (following IS NULL OR following > ts + INTERVAL 1 DAY)"
    ),
    "snapshot_diff": (
        f"WITH e AS (SELECT * FROM {O}), a AS (SELECT order_id, customer_id, CASE WHEN priority = '1-URGENT' THEN 'X' ELSE status END AS status, "
        f"priority, total, moment FROM {O} WHERE status <> 'O') "
        f"SELECT {O_COLUMNS}, 'expected' AS only_in, CAST(count(*) AS BIGINT) AS copies FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a) GROUP BY ALL "
        f"UNION ALL SELECT {O_COLUMNS}, 'actual', CAST(count(*) AS BIGINT) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e) GROUP BY ALL"
    ),
    "tenant_share": "SELECT user_id, count(*) AS row_count, count(*) / CAST((SELECT count(*) FROM events) AS DOUBLE) AS share FROM events GROUP BY user_id",
    "tenant_partitions": f"SELECT user_id AS tenant_id, {day('ts')} AS event_date, count(*) AS row_count FROM events GROUP BY ALL",
    "tenant_lake": f"SELECT {E_COLUMNS}, event_type AS tenant_id, {day('moment')} AS event_date FROM {E_}",
    "clustered_lake": (
        f"SELECT {E_COLUMNS}, 'user ' || user_id AS asked FROM {E_} WHERE user_id IN (1, 7, 42) "
        f"UNION ALL SELECT {E_COLUMNS}, 'week' AS asked FROM {E_} WHERE moment >= TIMESTAMP '2024-01-10' AND moment < TIMESTAMP '2024-01-17'"
    ),
    "microbatch_windows": (
        f"SELECT {iso('w')} AS window_start, count(*) AS row_count, {lanes('h')} FROM (SELECT time_bucket(INTERVAL '2 minutes', ts) AS w, "
        f"sha256({identity('events', 'event_id', 'ts')}) AS h FROM events) GROUP BY w"
    ),
    "freshness_sketch": "SELECT 'events' AS table_name, count(*) AS row_count, true AS within_bound FROM events",
    "noisy_tenants": (
        "WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d FROM events), ends AS (SELECT DISTINCT p.d + i AS last FROM (SELECT DISTINCT d FROM e) p, (SELECT CAST(unnest(range(7)) AS INTEGER) AS i) "
        "WHERE p.d + i <= (SELECT max(d) FROM e)), counted AS (SELECT last, user_id, count(*) AS n, sum(count(*)) OVER (PARTITION BY last) AS total "
        "FROM ends JOIN e ON e.d <= last AND e.d > last - 7 GROUP BY last, user_id) "
        f"SELECT {iso('CAST(last + 1 AS TIMESTAMP)')} AS window_end, user_id, n AS estimate, CAST(total AS BIGINT) AS rows FROM counted WHERE n >= total * 0.01"
    ),
}
ORACLE["microbatch_windows_stream"] = ORACLE["microbatch_windows"]
