"""DuckDB SQL for every registered query: the independent check.

The driver registers the supplied parquet tables as views; each statement
derives the canonical events from ``events`` with the fixture mapping (the same
fixed values as ``tidewater.fixtures``) and computes the expected result in
plain SQL. Silver equals the canonical events: the wire round trip, the junk
filter and the dedupe must give back exactly these rows.

DuckDB typing notes: ``sum(int)`` is HUGEINT and ``hour()`` BIGINT, hence the
casts; timestamps are compared as timestamp without zone.
"""

from __future__ import annotations

CANONICAL_CTE = """
src AS (
    SELECT event_id AS src_id,
           user_id AS src_user,
           ts,
           CAST(floor((epoch(ts) + 43200) / 172800) AS BIGINT) AS s,
           CAST(extract(day FROM ts) AS BIGINT) AS dd,
           event_type AS src_type,
           CAST(floor(value) AS INTEGER) AS v
    FROM events
),
canonical AS (
    SELECT
        src_id,
        src_user,
        concat('e-', CAST(src_id AS VARCHAR)) AS event_id,
        CASE WHEN src_id % 101 = 0 THEN ''
             WHEN src_user % 50 = 13 THEN concat('u-É', CAST(src_user AS VARCHAR))
             ELSE concat('u-', CAST(src_user AS VARCHAR)) END AS user_id,
        CASE WHEN src_id % 103 = 0 THEN repeat('s', 65)
             ELSE concat('s-', CAST(src_user AS VARCHAR), '-', CAST(s AS VARCHAR)) END AS session_id,
        CASE WHEN src_id % 107 = 0 THEN repeat('c', 65)
             WHEN src_id % 149 = 0 THEN concat('c-é', CAST((src_user * 7 + dd) % 100 AS VARCHAR))
             ELSE concat('c-', CAST((src_user * 7 + dd) % 100 AS VARCHAR)) END AS content_id,
        CASE WHEN src_id % 109 = 0 THEN ''
             WHEN src_id % 37 = 0 THEN 'trailer'
             WHEN ((src_user * 7 + dd) % 100) % 20 < 11 THEN 'series_episode'
             WHEN ((src_user * 7 + dd) % 100) % 20 < 17 THEN 'movie'
             WHEN ((src_user * 7 + dd) % 100) % 20 = 17 THEN 'short'
             WHEN ((src_user * 7 + dd) % 100) % 20 = 18 THEN 'trailer'
             ELSE 'live' END AS content_type,
        CASE WHEN src_id % 83 = 0 THEN NULL
             WHEN src_id % 89 = 0 THEN 'buffer'
             WHEN src_type = 'click' AND src_id % 3 = 1 THEN 'pause'
             WHEN src_type = 'view' AND src_id % 5 = 1 THEN 'skip'
             WHEN src_type = 'view' THEN 'play'
             WHEN src_type = 'click' THEN 'seek'
             WHEN src_type = 'purchase' THEN 'complete'
             WHEN src_type = 'signup' THEN 'resume'
             WHEN src_type = 'error' THEN 'error' END AS event_type,
        CASE WHEN src_id % 139 = 0 OR (src_user + dd) % 7 = 0 THEN NULL
             WHEN src_id % 97 = 0 THEN -5
             ELSE CAST(least(86400, sum(v) OVER (PARTITION BY src_user, s ORDER BY ts, src_id)) AS INTEGER) END
            AS watch_seconds,
        CASE WHEN src_id % 131 = 0 THEN 86401 WHEN src_id % 10 = 0 THEN NULL ELSE v END AS playback_position_seconds,
        CASE WHEN src_id % 43 = 0 THEN 'fridge'
             WHEN src_id % 41 = 0 THEN 'web'
             WHEN src_user % 20 < 9 THEN 'mobile_android'
             WHEN src_user % 20 < 12 THEN 'mobile_ios'
             WHEN src_user % 20 < 16 THEN 'smart_tv'
             WHEN src_user % 20 < 18 THEN 'web'
             ELSE 'tablet' END AS device_type,
        CASE WHEN src_id % 113 = 0 THEN repeat('9', 33)
             ELSE concat('1.', CAST(src_id % 5 AS VARCHAR), '.0') END AS app_version,
        CASE WHEN src_id % 127 = 0 THEN 'IND'
             WHEN src_user % 20 = 18 AND src_id % 2 = 0 THEN 'de'
             WHEN src_user % 20 < 11 THEN 'IN'
             WHEN src_user % 20 < 13 THEN 'US'
             WHEN src_user % 20 = 13 THEN 'GB'
             WHEN src_user % 20 = 14 THEN 'AE'
             WHEN src_user % 20 = 15 THEN 'SG'
             WHEN src_user % 20 = 16 THEN 'CA'
             WHEN src_user % 20 = 17 THEN 'AU'
             WHEN src_user % 20 = 18 THEN 'DE'
             ELSE 'BD' END AS country_code,
        ts AS event_timestamp
    FROM src
),
silver AS (
    SELECT *,
           CAST(event_timestamp AS DATE) AS event_date,
           CAST(hour(event_timestamp) AS INTEGER) AS event_hour
    FROM canonical
)"""


def with_silver(body: str) -> str:
    """Prefix a statement with the canonical/silver CTEs."""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + CANONICAL_CTE + ",\n" + body[5:]
    return "WITH " + CANONICAL_CTE + "\n" + body


# Wire records and Bronze rows derived from the canonical events, with the
# JSON text written exactly as Spark's to_json writes it (a NULL field as null,
# microsecond UTC timestamps with a Z offset).
WIRE_CTE = """
copies AS (
    SELECT c.*, k.copy
    FROM canonical c, (VALUES (0), (1), (2)) AS k(copy)
    WHERE k.copy = 0
       OR (k.copy = 1 AND c.src_id % 20 = 0)
       OR (k.copy = 2 AND c.src_id % 50 = 0)
),
wire AS (
    SELECT
        user_id AS kafka_key,
        CAST(src_user % 6 AS INTEGER) AS kafka_partition,
        CAST(src_id * 10 + copy AS BIGINT) AS kafka_offset,
        event_timestamp + to_seconds(copy) AS kafka_timestamp,
        copy,
        concat(
            '{"event_id":', coalesce(concat('"', event_id, '"'), 'null'),
            ',"user_id":', coalesce(concat('"', user_id, '"'), 'null'),
            ',"session_id":', coalesce(concat('"', session_id, '"'), 'null'),
            ',"content_id":', coalesce(concat('"', content_id, '"'), 'null'),
            ',"content_type":', coalesce(concat('"', content_type, '"'), 'null'),
            ',"event_type":', coalesce('"' || event_type || '"', 'null'),
            ',"watch_seconds":', coalesce(CAST(watch_seconds AS VARCHAR), 'null'),
            ',"playback_position_seconds":', coalesce(CAST(playback_position_seconds AS VARCHAR), 'null'),
            ',"device_type":', coalesce(concat('"', device_type, '"'), 'null'),
            ',"app_version":', coalesce(concat('"', app_version, '"'), 'null'),
            ',"country_code":', coalesce(concat('"', country_code, '"'), 'null'),
            ',"event_timestamp":"', strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ'), '"}') AS clean_value,
        copy < 2 AND src_id % 137 = 0 AS naive,
        CASE WHEN copy = 2 THEN 'not json'
             WHEN src_id % 137 = 0 AND src_id % 139 = 0
                 THEN replace(replace(clean_value, 'Z"}', '"}'), '"watch_seconds":null', '"watch_seconds":"bad"')
             WHEN src_id % 137 = 0 THEN replace(clean_value, 'Z"}', '"}')
             WHEN src_id % 139 = 0 THEN replace(clean_value, '"watch_seconds":null', '"watch_seconds":"bad"')
             ELSE clean_value END AS value,
        event_id, user_id, session_id, content_id, content_type, event_type, watch_seconds,
        playback_position_seconds, device_type, app_version, country_code, event_timestamp
    FROM copies
),
bronze AS (
    SELECT kafka_key, kafka_partition, kafka_offset, kafka_timestamp, naive,
           CASE WHEN copy < 2 THEN event_id END AS event_id,
           CASE WHEN copy < 2 THEN user_id END AS user_id,
           CASE WHEN copy < 2 THEN session_id END AS session_id,
           CASE WHEN copy < 2 THEN content_id END AS content_id,
           CASE WHEN copy < 2 THEN content_type END AS content_type,
           CASE WHEN copy < 2 THEN event_type END AS event_type,
           CASE WHEN copy < 2 THEN watch_seconds END AS watch_seconds,
           CASE WHEN copy < 2 THEN playback_position_seconds END AS playback_position_seconds,
           CASE WHEN copy < 2 THEN device_type END AS device_type,
           CASE WHEN copy < 2 THEN app_version END AS app_version,
           CASE WHEN copy < 2 THEN country_code END AS country_code,
           CASE WHEN copy < 2 THEN event_timestamp END AS event_timestamp
    FROM wire
)"""


def with_wire(body: str) -> str:
    """Prefix a statement with the canonical, silver, wire and bronze CTEs."""
    body = body.strip()
    head = "WITH " + CANONICAL_CTE + ",\n" + WIRE_CTE
    if body.upper().startswith("WITH "):
        return head + ",\n" + body[5:]
    return head + "\n" + body
