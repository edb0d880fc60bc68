"""The expected result of each query as DuckDB SQL over the typed source columns."""

from __future__ import annotations

from tollgate.workload.definitions import REVISION_1, REVISION_2, SCHEMA_NAME
from tollgate.workload.messages import ALL, DUCKDB, NONE, ODD, _LONGITUDE, payload_sql

NOW = "TIMESTAMP '2024-02-01 00:00:00'"

# What each fault leads to on each path; see workload.messages for what the faults are.
STANDARD_ERRORS = {
    1: "INVALID_JSON", 2: "INVALID_JSON", 5: "TYPE_MISMATCH:point_idx",
    7: "BAD_TIMESTAMP:timestamp", 8: "NOT_AN_OBJECT", 9: "INVALID_UTF8",
}
SCHEMA_ERRORS = {
    1: "INVALID_JSON", 2: "INVALID_JSON", 5: "TYPE_MISMATCH", 6: "BAD_TIMESTAMP",
    8: "NOT_AN_OBJECT", 9: "INVALID_UTF8", 11: "BAD_TIMESTAMP",
}
LINK_ERRORS = {1: "INVALID_JSON", 2: "INVALID_JSON", 5: "TYPE_MISMATCH:point_idx", 9: "INVALID_UTF8"}
V1_REASONS = {
    1: "INVALID_JSON", 2: "INVALID_JSON", 3: "MISSING_FIELD:passenger_count",
    4: "MISSING_FIELD:passenger_count", 5: "TYPE_MISMATCH:point_idx",
    7: "TYPE_MISMATCH:timestamp", 8: "NOT_AN_OBJECT", 9: "INVALID_UTF8",
}
DESCRIPTIONS = {
    "INVALID_UTF8": "payload is not valid UTF-8",
    "INVALID_JSON": "payload is not exactly one JSON value",
    "NOT_AN_OBJECT": "payload is JSON but not an object",
    "BAD_TIMESTAMP": "timestamp value cannot be read: timestamp",
    "TYPE_MISMATCH": "value does not have the type of the column: point_idx",
}


def _case(outcomes: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {fault} THEN '{text}'" for fault, text in outcomes.items())
    return f"CASE fault {whens} END"


def _in(outcomes: dict[int, str]) -> str:
    return "fault IN (" + ", ".join(str(fault) for fault in outcomes) + ")"


def _events(faults: bool = True, enriched: str = ODD) -> str:
    """A CTE ``m`` with the values every path should read from an event's message."""
    fault = "event_id % 97" if faults else "-1"
    return f"""
WITH m AS (
  SELECT event_id, event_type, ts, {fault} AS fault, ({enriched}) AS enriched,
    CAST(event_id AS VARCHAR) AS message_id,
    CASE WHEN event_id % 101 = 0 THEN {NOW} ELSE ts END AS publish_time,
    CASE WHEN event_id % 10 = 0 THEN '{{}}' ELSE '{{"source":"' || event_type || '"}}' END AS attributes,
    {payload_sql(DUCKDB, faults, enriched)[1]} AS payload,
    'ride-' || CAST(user_id AS VARCHAR) AS ride_id,
    event_id AS point_idx,
    CAST('40.' || CAST(70 + event_id % 15 AS VARCHAR) AS DOUBLE) AS latitude,
    CAST('-' || {_LONGITUDE.format(**DUCKDB)} AS DOUBLE) AS longitude,
    ts + INTERVAL 5 HOUR AS ride_time,
    CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS meter_reading,
    (event_id % 7) / 16.0::DOUBLE AS meter_increment,
    event_type AS ride_status,
    user_id % 6 AS passengers,
    CASE WHEN 70 + event_id % 15 > 80 THEN 'north'
         WHEN 70 + event_id % 15 > 75 THEN 'midtown' ELSE 'downtown' END AS area
  FROM events
)
"""


_M = _events()
_CLEAN = _events(faults=False)
_OK = f"NOT {_in(STANDARD_ERRORS)}"
_PASSENGERS = "CASE fault WHEN 3 THEN 0 WHEN 4 THEN NULL ELSE passengers END AS passenger_count"
_RIDE_TIME = 'CASE WHEN fault IN (6, 11) THEN NULL ELSE ride_time END AS "timestamp"'
_RIDE = f"""ride_id, point_idx, latitude, longitude, {_RIDE_TIME}, meter_reading, meter_increment,
  ride_status, {_PASSENGERS}"""
_V1 = """ride_id, point_idx, latitude, longitude, ride_time AS "timestamp", meter_reading,
  meter_increment, ride_status, passengers AS passenger_count"""
_V2 = f"""{_V1}, CASE WHEN enriched THEN ts END AS enrichment_timestamp,
  CASE WHEN enriched THEN area END AS region"""
_VERSION = "CASE WHEN enriched THEN 'v2 (enriched)' ELSE 'v1 (plain)' END AS schema_version"
_MINUTE = "date_trunc('minute', publish_time) AS minute"
# An array has no members, so the last link's condition is not true of it.
_GOES_ON = "(fault <> 8 AND (area <> 'downtown' OR event_id % 2 = 0))"
_RAW_OK = "fault NOT IN (1, 2, 9)"
_ENRICHED_RIDE = f"{_V1}, {NOW} AS enrichment_timestamp, area AS region"


def _plus_v2(reasons: dict[int, str]) -> dict[int, str]:
    return {**reasons, 12: "TYPE_MISMATCH:region"}


def _without(reasons: dict[int, str], *faults: int) -> dict[int, str]:
    return {fault: text for fault, text in reasons.items() if fault not in faults}


def _rule(rule: str) -> str:
    broken = {fault: text for fault, text in V1_REASONS.items() if text.startswith(rule)}
    return f"{_M} SELECT message_id, NOT {_in(broken)} AS ok FROM m"


def _dlq(errors: dict[int, str]) -> str:
    classes = {fault: text.split(":")[0] for fault, text in errors.items()}
    messages = {fault: DESCRIPTIONS[name] for fault, name in classes.items()}
    places = {
        fault: f"{text.split(':')[0]} at {text.split(':')[1] if ':' in text else 'payload'}"
        for fault, text in errors.items()
    }
    return f"""{_M} SELECT {NOW} AS processing_time, {_case(messages)} AS error_message,
  {_case(places)} AS stack_trace,
  CASE WHEN fault = 9 THEN '0xFF' || hex(encode(payload)) ELSE payload END AS original_payload,
  'rides-sub' AS subscription_name
FROM m WHERE {_in(errors)}"""


def _standard_rows(processing_time: str = "") -> str:
    return f"""{_M} SELECT 'rides-sub' AS subscription_name, message_id, publish_time, {processing_time}
  {_RIDE}, attributes FROM m WHERE {_OK}"""


ORACLES: dict[str, str] = {
    "src_messages": """
SELECT CAST(event_id AS VARCHAR) AS message_id,
  CASE WHEN event_id % 101 <> 0 THEN ts END AS publish_time,
  CAST(CASE WHEN event_id % 10 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_attributes
FROM events""",
    "utf8_routing": f"""{_M} SELECT message_id, fault <> 9 AS is_utf8,
  CASE WHEN fault = 9 THEN '0xFF' || hex(encode(payload)) ELSE payload END AS original_payload FROM m""",
    "json_validity": f"""{_M}
SELECT 'events' AS source, {_RAW_OK} AS is_valid, count(*) AS n FROM m GROUP BY ALL
UNION ALL
SELECT 'documents' AS source, json_valid(text) AS is_valid, count(*) AS n FROM documents GROUP BY ALL""",
    "std_flatten": _standard_rows(),
    "std_defaults": f"{_M} SELECT message_id, {_PASSENGERS} FROM m WHERE {_OK}",
    "std_timestamp_lenient": f"""{_M} SELECT message_id,
  CASE WHEN fault IN (6, 11) OR {_in(STANDARD_ERRORS)} THEN NULL ELSE ride_time END AS "timestamp",
  CASE WHEN {_OK} THEN 'table' ELSE 'dead_letter' END AS routed_to FROM m""",
    "route_counts": f"""{_M} SELECT CASE WHEN {_OK} THEN 'table' ELSE 'dead_letter' END AS routed_to,
  count(*) AS n FROM m GROUP BY 1""",
    "dlq_rows": _dlq(STANDARD_ERRORS),
    "raw_payload_verbatim": f"""{_M} SELECT message_id, md5(payload) AS payload_md5,
  length(payload) AS n_chars FROM m WHERE {_RAW_OK}""",
    "envelope_publish_time": f"{_M} SELECT message_id, publish_time FROM m WHERE {_RAW_OK}",
    "attributes_json": f"{_M} SELECT message_id, attributes FROM m WHERE {_RAW_OK}",
    "governance_attrs": f"""{_M} SELECT '{SCHEMA_NAME}' AS schema_name,
  CASE WHEN fault = 12 THEN '{REVISION_1.revision_id}' ELSE '{REVISION_2.revision_id}' END AS schema_revision_id,
  'JSON' AS schema_encoding, count(*) AS n FROM m WHERE NOT {_in(V1_REASONS)} GROUP BY ALL""",
    "schema_v1_extract": f"{_CLEAN} SELECT {_V1} FROM m",
    "schema_v2_extract": f"{_CLEAN} SELECT {_V2} FROM m",
    "schema_extra_ignored": f"""{_M} SELECT ride_id, point_idx, latitude, longitude,
  CASE WHEN fault = 7 THEN TIMESTAMP '1970-01-01 00:00:00.005' ELSE ride_time END AS "timestamp",
  meter_reading, meter_increment, ride_status,
  CASE WHEN fault IN (3, 4) THEN NULL ELSE passengers END AS passenger_count
FROM m WHERE NOT {_in(SCHEMA_ERRORS)}""",
    "schema_epoch_millis": "SELECT event_id, date_trunc('milliseconds', ts) AS ts FROM events",
    "schema_epoch_micros": "SELECT event_id, ts FROM events",
    "schema_logical_types": """
SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_date,
  o_orderkey % 86400000 * 1000 AS time_millis, o_orderkey % 86400000 * 1000 + 7 AS time_micros,
  o_orderstatus = 'O' AS is_open, o_totalprice AS total_price,
  hex(encode(o_orderpriority)) AS priority_hex
FROM orders""",
    "schema_quarantine": f"""{_M} SELECT coalesce({_case(SCHEMA_ERRORS)}, 'OK') AS error_class,
  count(*) AS n FROM m GROUP BY 1""",
    "enrich_region": f"{_CLEAN} SELECT area AS region, count(*) AS n FROM m GROUP BY 1",
    "enrich_timestamp": f"{_CLEAN} SELECT message_id, {NOW} AS enrichment_timestamp FROM m",
    "enrich_roundtrip": f"{_CLEAN} SELECT message_id, {_ENRICHED_RIDE} FROM m",
    "transform_chain": f"{_CLEAN} SELECT message_id, area AS region FROM m WHERE area <> 'downtown'",
    "transform_filter": f"""{_M} SELECT message_id FROM m
WHERE fault NOT IN (1, 2, 3, 4, 8, 9) AND passengers > 0""",
    "transform_five": f"""{_M} SELECT message_id, ride_id, area AS region, CAST(event_id % 2 AS VARCHAR) AS parity,
  area || CAST(event_id % 2 AS VARCHAR) AS mark FROM m WHERE NOT {_in(LINK_ERRORS)} AND {_GOES_ON}""",
    "transform_outcomes": f"""{_M} SELECT count(*) FILTER (WHERE NOT {_in(LINK_ERRORS)} AND {_GOES_ON}) AS delivered,
  count(*) FILTER (WHERE NOT {_in(LINK_ERRORS)} AND NOT {_GOES_ON}) AS filtered,
  count(*) FILTER (WHERE {_in(LINK_ERRORS)}) AS refused FROM m""",
    "transform_dead_letters": _dlq(LINK_ERRORS),
    "enrich_order": f"""{_M} SELECT place, message_id, CASE WHEN {_in(V1_REASONS)} THEN NULL
  WHEN fault = 12 AND place = 'subscription' THEN '{REVISION_1.revision_id}' ELSE '{REVISION_2.revision_id}' END AS revision,
  CASE WHEN NOT {_in(V1_REASONS)} THEN area END AS region, {_case(V1_REASONS)} AS reason
FROM m, (VALUES ('topic'), ('subscription')) AS p(place)""",
    "validate_required": _rule("MISSING_FIELD"),
    "validate_types": _rule("TYPE_MISMATCH"),
    "validate_extra_ok": f"{_M} SELECT message_id, NOT {_in(V1_REASONS)} AS ok FROM m",
    "revision_stamp": f"""{_M} SELECT CASE WHEN {_in(V1_REASONS)} THEN 'rejected'
  WHEN fault = 12 THEN '{REVISION_1.revision_id}' ELSE '{REVISION_2.revision_id}' END AS revision,
  count(*) AS n FROM m GROUP BY 1""",
    "revision_ranges": f"""{_M}, r AS (SELECT *, CASE WHEN publish_time < TIMESTAMP '2024-01-05' THEN 0
  WHEN publish_time < TIMESTAMP '2024-01-12' THEN 1 WHEN publish_time < TIMESTAMP '2024-01-20' THEN 2 ELSE 3 END AS held FROM m),
c AS (SELECT *, CASE WHEN held = 0 AND fault NOT IN (1, 2, 8, 9) THEN 'NO_REVISION'
  WHEN held = 3 THEN {_case(_plus_v2(V1_REASONS))} ELSE {_case(V1_REASONS)} END AS reject_reason FROM r)
SELECT message_id, reject_reason, CASE WHEN reject_reason IS NOT NULL THEN NULL
  WHEN held = 1 OR held = 2 AND fault = 12 THEN '{REVISION_1.revision_id}' ELSE '{REVISION_2.revision_id}' END AS revision_id FROM c""",
    "relay_accepted": f"""{_M} SELECT message_id, '{REVISION_1.revision_id}' AS revision,
  CAST(3 AS BIGINT) AS n_attributes FROM m WHERE NOT {_in(V1_REASONS)}""",
    "relay_rejected": f"{_M} SELECT message_id, {_case(V1_REASONS)} AS reason FROM m WHERE {_in(V1_REASONS)}",
    "relay_counts": f"""{_M} SELECT count(*) FILTER (WHERE NOT {_in(V1_REASONS)}) AS published,
  count(*) FILTER (WHERE {_in(V1_REASONS)}) AS errors FROM m""",
    "compat_audit": f"""{_M} SELECT coalesce({_case(_plus_v2(_without(V1_REASONS, 1, 2, 9)))}, 'CONFORMS') AS reason,
  count(*) AS n FROM m WHERE {_RAW_OK} GROUP BY 1""",
    "merge_v1_v2_streams": "SELECT unnest(['v1', 'v2']) AS version, count(*) AS n FROM events",
    "evolve_union_v1_v2": f"""SELECT * FROM ({_events(False, NONE)} SELECT {_V2} FROM m)
UNION ALL SELECT * FROM ({_events(False, ALL)} SELECT {_V2} FROM m)""",
    "part_daily_counts": f"""{_M} SELECT CAST(publish_time AS DATE) AS publish_date, count(*) AS n
FROM m WHERE {_OK} GROUP BY 1""",
    "append_two_writers": f"""{_M} SELECT 'w' || CAST(event_id % 2 AS VARCHAR) AS writer, event_id % 4 // 2 AS batch_id,
  CASE WHEN {_OK} THEN 'table' ELSE 'dead_letter' END AS routed_to, count(*) AS n FROM m GROUP BY ALL""",
    "batch_by_count": """
SELECT shard, batch_no, count(*) AS n FROM (
  SELECT event_id % 5 AS shard,
    (row_number() OVER (PARTITION BY event_id % 5 ORDER BY event_id) - 1) // 100 AS batch_no FROM events
) GROUP BY ALL""",
    "replay_raw_to_typed": _standard_rows(f"{NOW} AS processing_time,"),
    "dedup_messages": f"{_M} SELECT message_id, 'table' AS routed_to, count(*) AS n FROM m WHERE {_RAW_OK} GROUP BY ALL",
    "minute_stream": f"""{_CLEAN} SELECT date_trunc('minute', ts) AS minute, count(*) FILTER (WHERE enriched) AS v2_count,
  count(*) FILTER (WHERE NOT enriched) AS v1_count, count(*) AS total
FROM m WHERE event_id % 101 <> 0 GROUP BY 1
HAVING date_trunc('minute', ts) + INTERVAL 11 MINUTE <= (SELECT max(ts) FROM m WHERE event_id % 101 <> 0)""",
    "typed_view": f"""{_CLEAN} SELECT 'rides-sub' AS subscription_name, message_id, publish_time,
  {NOW} AS processing_time, {_V1} FROM m""",
    "mixed_overview_short": f"""{_CLEAN} SELECT {_VERSION}, count(*) AS message_count,
  count(DISTINCT ride_id) AS unique_rides FROM m GROUP BY 1""",
    "mixed_overview": f"""{_CLEAN} SELECT {_VERSION}, count(*) AS message_count,
  count(DISTINCT ride_id) AS unique_rides, min(publish_time) AS first_seen, max(publish_time) AS last_seen
FROM m GROUP BY 1""",
    "minute_timeline_short": f"""{_CLEAN} SELECT {_MINUTE}, count(*) FILTER (WHERE enriched) AS v2_count,
  count(*) FILTER (WHERE NOT enriched) AS v1_count FROM m GROUP BY 1 ORDER BY 1 DESC LIMIT 15""",
    "minute_timeline": f"""{_CLEAN} SELECT {_MINUTE}, count(*) FILTER (WHERE enriched) AS v2_count,
  count(*) FILTER (WHERE NOT enriched) AS v1_count, count(*) AS total
FROM m GROUP BY 1 ORDER BY 1 DESC LIMIT 15""",
    "sample_v1_v2": f"""{_CLEAN} SELECT CASE WHEN enriched THEN 'v2' ELSE 'v1' END AS version, ride_id,
  ride_status, latitude, CASE WHEN enriched THEN ts END AS enrichment_timestamp,
  CASE WHEN enriched THEN area END AS region, publish_time, message_id
FROM m ORDER BY publish_time DESC, message_id DESC LIMIT 20""",
    "region_distribution": f"""{_CLEAN} SELECT area AS region, count(*) AS count
FROM m WHERE enriched GROUP BY 1 ORDER BY 2 DESC""",
    "json_query_subdoc": """
SELECT conv_id, turn, to_json({'turn': turn, 'role': role, 'text': text})::VARCHAR AS turn_document,
  CAST(NULL AS VARCHAR) AS speaker_document FROM conversations""",
    "pipeline_lag": f"""{_M} SELECT {_MINUTE}, avg(event_id % 50 * 1000000) / 1000000 AS avg_lag_seconds,
  max(event_id % 50 * 1000000) / 1000000 AS max_lag_seconds,
  quantile_disc(event_id % 50 * 1000000, 0.95) / 1000000 AS p95_lag_seconds
FROM m WHERE {_RAW_OK} GROUP BY 1""",
    "throughput_per_second": f"""{_M} SELECT date_trunc('second', publish_time) AS second, count(*) AS n
FROM m WHERE {_RAW_OK} GROUP BY 1""",
}
