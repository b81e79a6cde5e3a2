"""The registered queries again as DuckDB SQL, for checking.

They share the fixture expressions with the Spark side and compute everything
else by DuckDB's own JSON, text and window functions.
"""

from __future__ import annotations

from rollbook.fixed import CONTAINERS, MAX_ATTEMPTS, QUOTA, TOPIC, USER_COLUMNS
from rollbook.plans.fixtures import (
    ATTEMPTS,
    BODY,
    RECORD,
    SENT_ID,
    SENT_TEXT,
    STATUS,
    TOPIC_OF,
)

_COLUMNS = ", ".join(USER_COLUMNS)


def _keyed(key: str) -> str:
    digest = f"md5(CAST({key} AS VARCHAR))"
    return f"""
        substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4)
        || '-3' || substr({digest}, 14, 3) || '-'
        || translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')
        || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)
    """


def _plain(path: str) -> str:
    return f"CASE WHEN json_type(u, '$.{path}') IS NULL THEN '' ELSE u ->> '$.{path}' END"


def _printed(path: str) -> str:
    return f"""
        CASE WHEN json_type(u, '$.{path}') IS NULL THEN ''
             WHEN json_type(u, '$.{path}') = 'NULL' THEN 'None'
             WHEN json_type(u, '$.{path}') = 'BOOLEAN' THEN
                  CASE u ->> '$.{path}' WHEN 'true' THEN 'True' ELSE 'False' END
             WHEN json_type(u, '$.{path}') = 'DOUBLE' THEN
                  CAST(CAST(u ->> '$.{path}' AS DOUBLE) AS VARCHAR)
             ELSE u ->> '$.{path}' END
    """


_RECORD_OF_USER = f"""
    {_keyed('request_id')} AS id,
    ({_printed('name.first')}) || ' ' || ({_printed('name.last')}) AS full_name,
    {_plain('gender')} AS gender,
    ({_printed('location.street.number')}) || ' ' || ({_printed('location.street.name')})
        || ', ' || ({_printed('location.city')}) || ', ' || ({_printed('location.state')})
        || ', ' || ({_printed('location.country')}) AS address,
    {_printed('location.postcode')} AS postcode,
    {_plain('email')} AS email,
    {_plain('login.username')} AS user_name,
    {_plain('dob.date')} AS dob,
    {_plain('registered.date')} AS registered_date,
    {_plain('phone')} AS phone,
    {_plain('picture.medium')} AS image
"""
_REASON = (
    "CASE WHEN json_type(u) <> 'OBJECT' THEN 'document is not an object' "
    + " ".join(
        f"WHEN json_type(u, '$.{path}') <> 'OBJECT' THEN '{path} is not an object'"
        for path in CONTAINERS
    )
    + " END"
)

_LANDED = f"""
    attempts AS (
        SELECT *, CAST(unnest(generate_series(1, {ATTEMPTS})) AS INTEGER) AS attempt FROM customer
    ),
    landed AS (
        SELECT c_custkey AS request_id, attempt, {STATUS} AS status, {BODY} AS body
        FROM attempts
    ),
    judged AS (
        SELECT *, status = 200 AND coalesce(
            CASE WHEN json_valid(body) AND json_type(body, '$.results') = 'ARRAY'
                 THEN json_array_length(body, '$.results') > 0 END, false) AS valid
        FROM landed
    ),
    found AS (
        SELECT *, json_extract(body, '$.results[0]') AS u FROM judged WHERE valid
    ),
    firsts AS (
        SELECT * FROM found WHERE attempt <= {MAX_ATTEMPTS}
        QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY attempt) = 1
    ),
    flat AS (
        SELECT request_id, attempt, {_REASON} AS reason, CAST(u AS VARCHAR) AS document,
               {_RECORD_OF_USER}
        FROM firsts
    ),
    exhausted AS (
        SELECT request_id, max(attempt) AS attempts FROM judged WHERE attempt <= {MAX_ATTEMPTS}
        GROUP BY request_id HAVING NOT bool_or(valid) AND max(attempt) >= {MAX_ATTEMPTS}
    )
"""

_IF_ACCEPTED = ", ".join(
    f"CASE WHEN outcome = 'accepted' THEN {name} END AS {name}" for name in USER_COLUMNS
)

_RECORD_OF_EVENT = ", ".join(f"{text} AS {name}" for name, text in RECORD.items())
_FIELDS = ", ".join(f"'{name}': {name}" for name in USER_COLUMNS)
_IS_UUID = (
    "coalesce(regexp_full_match(id, "
    "'[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}'), false)"
)
_DECODED = ", ".join(f"text ->> '$.{name}' AS {name}" for name in USER_COLUMNS)
_MESSAGES = f"""
    records AS (
        SELECT event_id, ts, {_keyed('user_id')} AS id, {_RECORD_OF_EVENT} FROM events
    ),
    sent AS (
        SELECT event_id, ts, {SENT_ID} AS id, {_COLUMNS.removeprefix('id, ')} FROM records
    ),
    encoded AS (
        SELECT event_id, ts, CAST(to_json({{{_FIELDS}}}) AS VARCHAR) AS json FROM sent
    ),
    log AS (
        SELECT {SENT_TEXT} AS value, {TOPIC_OF} AS topic,
               CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset", ts
        FROM encoded
    ),
    parsed AS (
        SELECT *, CASE WHEN json_valid(value) THEN value END AS text FROM log
    ),
    decoded AS (
        SELECT value, topic, "partition", "offset", ts, {_DECODED} FROM parsed
    ),
    screened AS (
        SELECT *, CASE WHEN value IS NULL THEN 'empty message'
                       WHEN NOT json_valid(value) THEN 'malformed JSON'
                       WHEN id IS NULL THEN 'missing id'
                       WHEN NOT {_IS_UUID} THEN 'id is not a UUID' END AS reason
        FROM decoded
    ),
    accepted AS (
        SELECT * REPLACE (lower(id) AS id) FROM screened
        WHERE reason IS NULL AND topic = '{TOPIC}'
    ),
    newest AS (
        SELECT {_COLUMNS} FROM accepted
        QUALIFY row_number() OVER (
            PARTITION BY id ORDER BY ts DESC, "partition" DESC, "offset" DESC) = 1
    )
"""

_RECORDS = f"WITH {_MESSAGES} SELECT {_COLUMNS} FROM accepted"
_NEWEST = f"WITH {_MESSAGES} SELECT {_COLUMNS} FROM newest"
_REJECTS = f"""
    WITH {_MESSAGES} SELECT "partition", "offset", reason, value FROM screened
    WHERE reason IS NOT NULL
"""

ORACLES: dict[str, str] = {
    "raw_valid": f"WITH {_LANDED} SELECT request_id, attempt, status, body FROM judged WHERE valid",
    "first_result": f"""
        WITH {_LANDED} SELECT request_id, attempt, CAST(u AS VARCHAR) AS user FROM found
    """,
    "first_valid_attempt": f"""
        WITH {_LANDED} SELECT request_id, attempt, CAST(u AS VARCHAR) AS user FROM firsts
    """,
    "exhausted_requests": f"WITH {_LANDED} SELECT request_id, attempts FROM exhausted",
    "format_user_record": f"""
        WITH {_LANDED} SELECT request_id, {_COLUMNS} FROM flat WHERE reason IS NULL
    """,
    "format_rejects": f"""
        WITH {_LANDED} SELECT request_id, reason, document FROM flat WHERE reason IS NOT NULL
    """,
    "request_outcomes": f"""
        WITH {_LANDED}, tried AS (
            SELECT request_id, max(attempt) AS attempts FROM judged
            WHERE attempt <= {MAX_ATTEMPTS} GROUP BY request_id
        ),
        known AS (
            SELECT tried.request_id, coalesce(flat.attempt, tried.attempts) AS attempts,
                   CASE WHEN flat.request_id IS NULL AND attempts < {MAX_ATTEMPTS} THEN 'pending'
                        WHEN flat.request_id IS NULL THEN 'exhausted'
                        WHEN reason IS NOT NULL THEN 'rejected' ELSE 'accepted' END AS outcome,
                   reason, document, {_COLUMNS}
            FROM tried LEFT JOIN flat ON flat.request_id = tried.request_id
        )
        SELECT request_id, attempts, outcome, reason,
               CASE WHEN outcome = 'rejected' THEN document END AS document,
               {_IF_ACCEPTED}
        FROM known
    """,
    "deterministic_id": f"""
        SELECT event_id, {_keyed('user_id')} AS user_key, {_keyed('event_id')} AS event_key
        FROM events
    """,
    "quota_limit": f"""
        WITH {_LANDED} SELECT request_id, {_COLUMNS} FROM flat WHERE reason IS NULL
        ORDER BY request_id LIMIT {QUOTA}
    """,
    "publish_count": f"""
        WITH {_LANDED}, used AS (
            SELECT request_id FROM flat WHERE reason IS NULL ORDER BY request_id LIMIT {QUOTA}
        ),
        gone_through AS (
            SELECT DISTINCT request_id FROM landed
            WHERE request_id <= (SELECT max(request_id) FROM used)
               OR (SELECT count(*) FROM used) < {QUOTA}
        ),
        counts AS (
            SELECT count(*) FILTER (flat.request_id IS NOT NULL AND reason IS NULL) AS accepted,
                   count(*) FILTER (reason IS NOT NULL) AS rejected,
                   count(exhausted.request_id) AS exhausted, count(*) AS requests
            FROM gone_through g
            LEFT JOIN flat ON flat.request_id = g.request_id
            LEFT JOIN exhausted ON exhausted.request_id = g.request_id
        )
        SELECT accepted, rejected, exhausted,
               requests - accepted - rejected - exhausted AS pending,
               (SELECT count(*) FROM used) AS published
        FROM counts
    """,
    "wire_encode": f"""
        WITH {_MESSAGES} SELECT '{TOPIC}' AS topic,
            CAST(to_json({{{_FIELDS}}}) AS VARCHAR) AS value FROM records
    """,
    "topic_subscribe": f"""
        WITH {_MESSAGES} SELECT topic, "partition", "offset", value FROM log
        WHERE topic = '{TOPIC}'
    """,
    "value_cast": f"WITH {_MESSAGES} SELECT value FROM log",
    "wire_decode": f"WITH {_MESSAGES} SELECT {_COLUMNS} FROM decoded",
    "uuid_valid": f"""
        WITH {_MESSAGES} SELECT id, registered_date, {_IS_UUID} AS storable FROM decoded
    """,
    "undecodable_rejects": _REJECTS,
    "ensure_table": _NEWEST,
    "stream_append": _RECORDS,
    "stream_rate_limited": f"""
        WITH {_MESSAGES} SELECT "offset" % 3 AS batch_id, count(*) AS messages, count(reason) AS rejects
        FROM screened WHERE topic = '{TOPIC}' GROUP BY 1
    """,
    "stream_record_limited": f"""
        WITH {_MESSAGES}, landed AS (SELECT "partition", count(*) AS c FROM screened WHERE topic = '{TOPIC}' GROUP BY 1),
        files AS (SELECT c, unnest(generate_series(0, (c - 1) // 3000)) AS i FROM landed)
        SELECT least(3000, c - 3000 * i) AS messages, count(*) AS batches FROM files GROUP BY 1
    """,
    "stream_progress": f"""
        WITH {_MESSAGES} SELECT "offset" % 3 AS batch_id, count(*) AS messages, count(reason) AS rejects
        FROM screened WHERE topic = '{TOPIC}' GROUP BY 1
    """,
    "stream_resume": _RECORDS,
    "stream_rejects": f"{_REJECTS} AND topic = '{TOPIC}'",
    "keyed_upsert": _NEWEST,
    "replay_idempotent": _NEWEST,
    "scheduled_runs": f"WITH {_LANDED} SELECT {_COLUMNS} FROM flat WHERE reason IS NULL",
    "live_view": _NEWEST,
    "compacted_log": _NEWEST,
    "two_checkpoints": _RECORDS,
    "store_and_log": f"""
        WITH {_MESSAGES} SELECT {_COLUMNS}, held_by
        FROM newest, (SELECT unnest(['store', 'log']) AS held_by)
    """,
    "random_id": """
        SELECT count(*) AS storable, count(*) AS random, count(*) AS distinct_ids FROM events
    """,
    "quota_runs": f"""
        WITH {_LANDED}, good AS (SELECT request_id, id FROM flat WHERE reason IS NULL),
        run_0 AS (
            SELECT request_id FROM good WHERE request_id % 3 = 0 ORDER BY request_id LIMIT {QUOTA}
        ),
        run_1 AS (
            SELECT request_id FROM good WHERE request_id % 3 <= 1 AND request_id NOT IN (FROM run_0)
            ORDER BY request_id LIMIT {QUOTA}
        ),
        run_2 AS (
            SELECT request_id FROM good WHERE request_id NOT IN (FROM run_0)
                AND request_id NOT IN (FROM run_1) ORDER BY request_id LIMIT {QUOTA}
        )
        SELECT request_id, id,
               CAST(CASE WHEN request_id IN (FROM run_0) THEN 0 WHEN request_id IN (FROM run_1) THEN 1
                         WHEN request_id IN (FROM run_2) THEN 2 END AS BIGINT) AS run
        FROM good
    """,
    "producer_replay": f"""
        WITH {_LANDED} SELECT phone, CAST(1 AS BIGINT) AS ids FROM flat WHERE reason IS NULL
    """,
    "end_to_end": f"WITH {_LANDED} SELECT {_COLUMNS} FROM flat WHERE reason IS NULL",
}
ORACLES["split_attempts"] = ORACLES["request_outcomes"]
