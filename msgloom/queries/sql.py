"""Pieces of SQL shared by the queries' oracles: the derivations of ``tables.py``."""

from __future__ import annotations

from collections.abc import Iterable

from msgloom import config
from msgloom.schemas import NOTIFICATION


def json_sql(fields: Iterable[tuple[str, str, bool]]) -> str:
    """JSON text of (name, expression, quoted), null fields left out."""
    parts = []
    for name, expression, quoted in fields:
        mark = '"' if quoted else ""
        parts.append(f"""'"{name}":{mark}' || CAST({expression} AS VARCHAR) || '{mark}'""")
    return "('{' || concat_ws(',', " + ", ".join(parts) + ") || '}')"


def id_sql(*keys: str) -> str:
    """The id of a row from the texts of its keys."""
    parts = (f"coalesce(length(CAST({k} AS VARCHAR)) || ':' || CAST({k} AS VARCHAR), '-')" for k in keys)
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


def escaped(expression: str) -> str:
    """A text as it stands inside a JSON text."""
    return rf"""replace(replace({expression}, '\', '\\'), '"', '\"')"""


def case_sql(expression: str, names: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in names.items())
    return f"(CASE {expression} {whens} ELSE '{default}' END)"


def listed(values: Iterable[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def union_twice(columns: str, source: str, when: str) -> str:
    return f"SELECT {columns} FROM {source} UNION ALL SELECT {columns} FROM {source} WHERE {when}"


def tables_with_k() -> str:
    return "src AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"


# --- message events ----------------------------------------------------------------
_EXTRA = json_sql(
    [
        ("From Country", "'US'", True),
        ("IP Address", "'10.0.0.' || k", True),
        ("Message Body", "'Extra ' || k", True),
    ]
)
_PROPERTIES = json_sql(
    [
        ("To Number", "'+1555' || user_id", True),
        ("From Number", "'+1666' || user_id", True),
        ("Message Body", "CASE WHEN k % 4 <> 0 THEN 'Offer ' || k END", True),
        ("Message Name", "'Name ' || (k % 6)", True),
        ("Campaign Name", "'Campaign ' || (k % 7)", True),
        ("Bot Click", "CASE WHEN k % 7 <> 0 THEN k % 5 = 0 END", False),
        ("$campaign", "'c' || (k % 7)", True),
        ("$message", "CASE WHEN k % 13 <> 0 THEN 'm' || (k % 10) END", True),
        ("Credits", "CASE WHEN k % 9 <> 0 THEN k % 4 END", False),
        ("$usage_amount", "k % 3", False),
        ("$extra", _EXTRA, False),
    ]
)
EVENT_CTES = f"""
{tables_with_k()},
coded AS (
  SELECT *,
    CASE WHEN k % 25 = 24 THEN 'QQQQQQ'
         WHEN event_type = 'click' THEN 'Uv32rW'
         WHEN event_type = 'view' THEN 'SGB8Vt'
         WHEN event_type = 'signup' THEN 'XsRJQh'
         WHEN event_type = 'error' THEN 'Y5SMsU'
         WHEN k % 2 = 0 THEN 'SBXSA5' ELSE 'S5A6iQ' END AS metric_id,
    {_PROPERTIES} AS full_properties_json
  FROM src),
landed AS ({union_twice("*", "coded", "k % 10 = 3")}),
raw AS (
  SELECT 'e' || event_id AS source_event_id,
    'event' AS record_type,
    CAST(epoch_us(ts) // 1000000 AS INT) AS unix_timestamp,
    strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS event_timestamp,
    'u' || event_id AS event_uuid,
    metric_id,
    CASE WHEN k % 11 <> 0 OR k % 22 <> 0 THEN 'p' || user_id END AS profile_id,
    'c' || (k % 7) AS campaign_id,
    CASE WHEN k % 13 <> 0 THEN 'm' || (k % 10) END AS message_id,
    CASE WHEN metric_id IN {listed(config.FROM_NUMBER_CODES)}
         THEN '+1666' || user_id ELSE '+1555' || user_id END AS phone,
    '+1555' || user_id AS destination_address,
    '+1666' || user_id AS source_address,
    CASE WHEN k % 4 <> 0 THEN 'Offer ' || k END AS content_body,
    'Extra ' || k AS extra_message_body,
    'Name ' || (k % 6) AS message_name,
    CAST(NULL AS VARCHAR) AS media_url,
    CAST(NULL AS VARCHAR) AS format,
    CAST(NULL AS VARCHAR) AS message_type,
    'Campaign ' || (k % 7) AS campaign_name,
    CAST(NULL AS VARCHAR) AS failure_type,
    CASE WHEN metric_id = 'SBXSA5' THEN k % 3 WHEN k % 9 <> 0 THEN k % 4 END AS credits_used,
    CAST(NULL AS BOOLEAN) AS is_spam,
    CASE WHEN k % 7 <> 0 THEN k % 5 = 0 END AS bot_click,
    '10.0.0.' || k AS ip_address,
    full_properties_json,
    CAST(year(ts) AS INT) AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
  FROM landed WHERE metric_id IN {listed(config.EVENT_NAMES)}),
raw_layer AS (
  SELECT *, CAST(credits_used * CAST(0.09 AS DOUBLE) AS FLOAT) AS cost_usd,
    {id_sql("source_event_id", "year", "month", "day")} AS raw_id
  FROM raw),
once AS (SELECT DISTINCT * FROM raw_layer),
named AS (SELECT *, {case_sql("metric_id", config.EVENT_NAMES, "Unknown")} AS event_name FROM once),
touched AS (
  SELECT * FROM named WHERE event_name <> 'SMS Clicked'
  UNION ALL
  SELECT * FROM (SELECT * FROM named
                 WHERE event_name = 'SMS Clicked' AND NOT coalesce(bot_click, FALSE))
  QUALIFY row_number() OVER (PARTITION BY year, month, day, profile_id, message_id
                             ORDER BY unix_timestamp, source_event_id) = 1),
optimized AS (
  SELECT *, 'SMS' AS channel_calc,
    {case_sql("event_name", config.EVENT_STATUSES, "OTHER")} AS status_calc,
    CASE WHEN event_name IN {listed(config.INBOUND_EVENTS)} THEN 'MO' ELSE 'MT' END AS direction,
    CASE WHEN metric_id IN {listed(config.EXTRA_BODY_CODES)} THEN extra_message_body
         WHEN metric_id IN {listed(config.NO_BODY_CODES)} THEN NULL
         ELSE coalesce(content_body, message_name) END AS content_calc,
    {id_sql("'optimized'", "raw_id")} AS optimized_id
  FROM touched)
"""
# Columns outside the contract, in the order the layer has them.
_EVENT_UNMAPPED = json_sql(
    [
        ("record_type", "record_type", True),
        ("unix_timestamp", "unix_timestamp", False),
        ("event_uuid", "event_uuid", True),
        ("metric_id", "metric_id", True),
        ("profile_id", "profile_id", True),
        ("message_id", "message_id", True),
        ("destination_address", "destination_address", True),
        ("source_address", "source_address", True),
        ("content_body", "content_body", True),
        ("extra_message_body", "extra_message_body", True),
        ("message_name", "message_name", True),
        ("credits_used", "credits_used", False),
        ("cost_usd", "cost_usd", False),
        ("bot_click", "bot_click", False),
        ("full_properties_json", escaped("full_properties_json"), True),
        ("year", "year", False),
        ("month", "month", True),
        ("day", "day", True),
        ("raw_id", "raw_id", True),
        ("event_name", "event_name", True),
        ("channel_calc", "channel_calc", True),
        ("direction", "direction", True),
        ("optimized_id", "optimized_id", True),
        ("r_created_at_opt", "'2024-02-01T00:00:00.000Z'", True),
    ]
)


def unified_sql(given: dict[str, str], source: str) -> str:
    """The 47 contract columns: the given expressions, typed nulls for the rest."""
    from msgloom.schemas import UNIFIED

    kinds = {"string": "VARCHAR", "int": "INT", "timestamp": "TIMESTAMP", "date": "DATE"}
    columns = [
        f'CAST({given.get(f.name, "NULL")} AS {kinds[f.dataType.simpleString()]}) AS "{f.name}"'
        for f in UNIFIED.fields
    ]
    return f"SELECT {', '.join(columns)} FROM {source}"


EVENT_UNIFIED = unified_sql(
    {
        "id": id_sql("'unified'", "optimized_id"),
        "batch_id": "(SELECT count(DISTINCT CAST(e.ts AS DATE)) FROM events e"
        " WHERE CAST(e.ts AS DATE) <= make_date(optimized.year, CAST(optimized.month AS INT),"
        " CAST(optimized.day AS INT)))",
        "r_created_at": "TIMESTAMP '2024-02-01 00:00:00'",
        "r_updated_at": "TIMESTAMP '2024-02-01 00:00:00'",
        "connector_id": "'12'",
        "source_id": "source_event_id",
        "timestamp": "replace(event_timestamp, '+00:00', '')",
        "source": "'events'",
        "user_id": "'7001'",
        "event_type": "channel_calc",
        "campaign_id": "campaign_id",
        "ip_address": "ip_address",
        "phone": "phone",
        "status": "status_calc",
        "channel": "channel_calc",
        "utm_content": "content_calc",
        "utm_term": "campaign_name",
        "utm_campaign": "'R-CPL-001'",
        "utm_source": "'aff-cc'",
        "utm_medium": "'affiliate'",
        "unmapped": _EVENT_UNMAPPED,
        "event_date": "substr(event_timestamp, 1, 10)",
    },
    "optimized WHERE status_calc <> 'OTHER'",
)

# --- notifications -----------------------------------------------------------------
_STATS = json_sql(
    [
        (name, f"n % {i + 2}", False)
        for i, name in enumerate(
            (
                "successful",
                "failed",
                "errored",
                "converted",
                "received",
                "suppressed",
                "frequency_capped",
                "provider_successful",
                "provider_failed",
                "provider_errored",
            )
        )
    ]
)
# Every field of a record, in the record's order; complex ones as JSON. Others are null.
_RECORD = {
    "id": "id",
    "app_id": "'app'",
    "name": "name",
    "canceled": "canceled",
    "contents": """CASE WHEN content_text IS NOT NULL THEN '{"en":"' || content_text || '"}' END""",
    "headings": """CASE WHEN creative_title IS NOT NULL THEN '{"en":"' || creative_title || '"}' END""",
    "queued_at": "queued_at",
    "completed_at": "completed_at",
    "successful": "successful",
    "failed": "failed",
    "errored": "errored",
    "converted": "converted",
    "platform_delivery_stats": f"""CASE WHEN n % 11 <> 0 THEN '{{"ios":' || {_STATS} || '}}' END""",
    "isSMS": "is_sms",
    "isEmail": "is_email",
    "sms_from": "'+15550100'",
    "email_subject": "email_subject",
    "included_segments": """CASE WHEN n % 12 = 0 THEN '[]'
      WHEN n % 12 <> 1 THEN '["' || order_status || '","All"]' END""",
    "priority": "priority",
    "url": "CASE WHEN n % 15 = 1 THEN primary_link END",
    "web_url": "CASE WHEN n % 15 = 2 THEN primary_link END",
    "app_url": "CASE WHEN n % 15 = 3 THEN primary_link END",
}
_RECORD_ID = id_sql(*(_RECORD.get(name, "NULL") for name in NOTIFICATION.fieldNames()))
NOTIFICATION_CTES = f"""
one AS (
  SELECT 'n' || o_orderkey AS id, o_orderkey AS n, o_orderstatus AS order_status,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'Campaign ' || o_orderpriority END AS name,
    CASE WHEN o_orderkey % 5 <> 1 THEN o_orderstatus = 'P' END AS canceled,
    CASE WHEN o_orderkey % 13 <> 0 THEN 'Hi {{{{name}}}}, order ' || o_orderkey ||
      CASE WHEN o_orderkey % 3 = 0 THEN ' http://x.test/a' ELSE '' END END AS content_text,
    CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS creative_title,
    CASE WHEN o_orderkey % 8 <> 0 THEN 1704067200 + day(o_orderdate) * 86400 END AS queued_at,
    CASE WHEN o_orderkey % 16 <> 0 THEN 1704067200 + day(o_orderdate) * 86400 + 3600 END AS completed_at,
    CAST(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 50 END AS INT) AS successful,
    CAST(o_orderkey % 5 AS INT) AS failed,
    CAST(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 3 END AS INT) AS errored,
    CAST(o_orderkey % 10 AS INT) AS converted,
    CASE WHEN o_orderkey % 10 <> 7 THEN o_orderkey % 3 = 1 END AS is_sms,
    CASE WHEN o_orderkey % 10 <> 9 THEN o_orderkey % 3 = 2 END AS is_email,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Subject ' || o_orderkey END AS email_subject,
    CASE WHEN o_orderkey % 12 = 0 THEN '' WHEN o_orderkey % 12 = 1 THEN 'ALL_USERS'
         ELSE o_orderstatus || ',All' END AS audience_segments,
    CASE WHEN o_orderkey % 15 = 1 THEN 'https://bit.ly/' || o_orderkey
         WHEN o_orderkey % 15 = 2 THEN 'https://w.test/' || o_orderkey
         WHEN o_orderkey % 15 = 3 THEN 'https://a.test/aff_ad/' || o_orderkey END AS primary_link,
    CAST(o_orderkey % 4 AS INT) AS priority
  FROM orders),
landed AS ({union_twice("*", "one", "n % 10 = 4")}),
stamped AS (
  SELECT *,
    CASE WHEN is_email THEN 'EMAIL' WHEN is_sms THEN 'SMS'
         ELSE 'PUSH_NOTIFICATION' END AS eventtype,
    coalesce(CAST(to_timestamp(queued_at) AT TIME ZONE 'UTC' AS DATE),
             CAST(to_timestamp(completed_at) AT TIME ZONE 'UTC' AS DATE),
             DATE '2024-02-01') AS event_date,
    to_timestamp(queued_at) AT TIME ZONE 'UTC' AS queued_ts,
    to_timestamp(completed_at) AT TIME ZONE 'UTC' AS completed_ts,
    {_RECORD_ID} AS record_id
  FROM landed),
counted AS (
  SELECT *, coalesce(successful, 0) + failed + coalesce(errored, 0) AS sends,
    coalesce(successful, 0) AS delivered, coalesce(errored, 0) AS rejected
  FROM (SELECT DISTINCT * FROM stamped)),
campaigns AS (
  SELECT {id_sql("'opt_id'", "id", "record_id")} AS opt_id, id AS campaign_id,
    coalesce(name, 'Unknown Campaign') AS campaign_name, record_id AS raw_record_id,
    1 AS batch_id, sends, delivered, failed AS failed_count, rejected,
    failed + rejected AS total_failed, converted AS clicks,
    CASE WHEN sends > 0 THEN round(CAST(delivered AS DOUBLE) / sends * 100, 2)
         ELSE 0.0 END AS success_rate,
    CASE WHEN delivered > 0 THEN round(CAST(converted AS DOUBLE) / delivered * 100, 2)
         ELSE 0.0 END AS click_through_rate,
    eventtype AS message_type, audience_segments, event_date AS send_date,
    queued_ts AS send_datetime,
    CASE WHEN canceled THEN 'CANCELED' WHEN completed_ts IS NOT NULL THEN 'COMPLETED'
         ELSE 'IN_PROGRESS' END AS delivery_status,
    content_text AS creative_content, creative_title,
    regexp_replace(coalesce(content_text, ''), '\\{{\\{{[^}}]+\\}}\\}}', '', 'g')
      AS content_text_clean,
    CASE WHEN primary_link IS NOT NULL OR content_text LIKE '%http%' THEN 1 ELSE 0
      END AS has_links,
    primary_link,
    CASE WHEN regexp_matches(primary_link, '{config.SHORT_LINK}') THEN 'YES'
         WHEN primary_link IS NOT NULL THEN 'NO' END AS links_shortened,
    CAST(NULL AS INT) AS replies, sends AS recipient_count,
    CASE WHEN eventtype = 'SMS' THEN '+15550100' END AS sending_number,
    CASE WHEN eventtype = 'SMS' THEN {json_sql([
        ("sms_delivered", "delivered", False), ("sms_failed", "failed", False),
        ("sms_from_number", "'+15550100'", True)])} END AS sms_metrics,
    CASE WHEN eventtype = 'EMAIL' THEN {json_sql([
        ("email_delivered", "delivered", False), ("email_clicks", "converted", False),
        ("email_subject", "email_subject", True)])} END AS email_metrics,
    CASE WHEN eventtype = 'PUSH_NOTIFICATION' THEN {json_sql([
        ("push_delivered", "delivered", False), ("push_clicks", "converted", False),
        ("priority", "priority", False)])} END AS push_metrics,
    CASE WHEN n % 11 <> 0 THEN '{{"ios":' || {_STATS} || '}}' END AS platform_stats,
    '20240201' AS processing_date,
    TIMESTAMP '2024-02-01 00:00:00' AS r_created_at,
    TIMESTAMP '2024-02-01 00:00:00' AS r_updated_at,
    CAST(NULL AS VARCHAR) AS profile_workspace_id, '7001' AS user_id,
    CAST(NULL AS VARCHAR) AS account_id, 'notices' AS source, '11' AS connector_id
  FROM counted)
"""
NOTIFICATION_UNMAPPED = json_sql(
    [
        ("campaign_name", "campaign_name", True),
        ("raw_record_id", "raw_record_id", True),
        ("sends", "sends", False),
        ("delivered", "delivered", False),
        ("failed_count", "failed_count", False),
        ("rejected", "rejected", False),
        ("total_failed", "total_failed", False),
        ("clicks", "clicks", False),
        ("success_rate", "success_rate", False),
        ("click_through_rate", "click_through_rate", False),
        ("audience_segments", "audience_segments", True),
        ("delivery_status", "delivery_status", True),
        ("creative_content", "creative_content", True),
        ("creative_title", "creative_title", True),
        ("content_text_clean", "content_text_clean", True),
        ("has_links", "has_links", False),
        ("primary_link", "primary_link", True),
        ("links_shortened", "links_shortened", True),
        ("recipient_count", "recipient_count", False),
        ("sending_number", "sending_number", True),
        ("sms_metrics", escaped("sms_metrics"), True),
        ("email_metrics", escaped("email_metrics"), True),
        ("push_metrics", escaped("push_metrics"), True),
        ("platform_stats", escaped("platform_stats"), True),
        ("processing_date", "processing_date", True),
    ]
)
NOTIFICATION_UNIFIED = unified_sql(
    {
        "id": id_sql("'id'", "opt_id"),
        "batch_id": "1",
        "r_created_at": "r_created_at",
        "r_updated_at": "r_updated_at",
        "connector_id": "connector_id",
        "source_id": "opt_id",
        "timestamp": "coalesce(send_datetime, TIMESTAMP '2024-02-01 00:00:00')",
        "source": "source",
        "user_id": "user_id",
        "event_type": "message_type",
        "campaign_id": "campaign_id",
        "unmapped": NOTIFICATION_UNMAPPED,
        "event_date": "send_date",
    },
    "campaigns",
)

# --- leads -------------------------------------------------------------------------
_DIGITS = "lpad(CAST(n AS VARCHAR), 7, '0')"
_SLOT_FLAGS = ", ".join(f"((n >> {i}) & 5) = 5 AS {s}" for i, s in enumerate(config.SLOTS))
LEAD_CTES = f"""
given AS (
  SELECT n, c_name, c_mktsegment,
    CASE WHEN n % 6 = 0 THEN '(555) ' || {_DIGITS} WHEN n % 6 = 1 THEN '1555' || {_DIGITS}
         WHEN n % 6 = 2 THEN '+1-555-' || {_DIGITS} WHEN n % 60 = 3 THEN ''
         WHEN n % 60 = 9 THEN 'none' WHEN n % 60 = 15 THEN NULL
         ELSE '555.' || {_DIGITS} END AS phone
  FROM (SELECT *, c_custkey AS n FROM customer)),
lead AS (
  SELECT CASE WHEN n % 40 <> 7 THEN 'Agent A' || (n % 17) END AS agent_name,
    '+155502' || lpad(CAST(n % 17 AS VARCHAR), 2, '0') AS agent_phone,
    CASE WHEN n % 9 <> 0 THEN '98' || (n % 100) END AS zip_code,
    CASE WHEN n % 4 <> 1 THEN CAST(n % 5 AS VARCHAR) END AS beds,
    CASE WHEN n % 8 <> 1 THEN CAST(n % 3 AS VARCHAR) END AS baths,
    n % 2 = 0 AS is_flexible, c_mktsegment AS message,
    CASE WHEN n % 3 <> 0 THEN n % 3 = 1 END AS use_first_selection_logic,
    CASE WHEN n % 5 <> 0 THEN c_name END AS consumer_name,
    CASE WHEN phone = '' THEN phone
         WHEN regexp_replace(phone, '[^0-9]', '', 'g') = '' THEN NULL
         ELSE '+1' || regexp_replace(regexp_replace(phone, '[^0-9]', '', 'g'), '^1', '')
      END AS consumer_phone,
    CASE WHEN n % 30 <> 11 THEN 'Road ' || n END AS address_line,
    {_SLOT_FLAGS}
  FROM given)
"""
SLOT_PICK = (
    "coalesce("
    + ", ".join(f"CASE WHEN {s} THEN '{t}' END" for s, t in config.SLOT_TITLES.items())
    + f", '{config.DEFAULT_SLOT_TITLE}')"
)
_SLOT_LIST = (
    "list_filter(["
    + ", ".join(f"CASE WHEN {s} THEN '{t}' END" for s, t in config.SLOT_PHRASES.items())
    + "], lambda x: x IS NOT NULL)"
)
AVAILABILITY = f"""
(CASE len({_SLOT_LIST})
  WHEN 0 THEN 'I''ve shared that your availability is flexible.'
  WHEN 1 THEN 'I''ve shared that you''re available ' || {_SLOT_LIST}[1] || '.'
  ELSE 'I''ve shared that you''re available '
    || array_to_string({_SLOT_LIST}[1:-2], ', ') || ' or ' || {_SLOT_LIST}[-1] || '.' END)
"""
THREE_WAY = f"""
(CASE WHEN coalesce(use_first_selection_logic, TRUE) THEN
  CASE WHEN consumer_name <> '' THEN 'Hi ' || consumer_name || ', ' ELSE 'Hi, ' END
  || 'congratulations.' || chr(10) || 'I''m connecting you with ' || agent_name
  || ', who''ll be helping you with your cash offer. His phone number is ' || agent_phone || '.'
  || chr(10) || chr(10) || agent_name || ' will visit your property at ' || address_line || ' on '
  || {SLOT_PICK} || ' and can often deliver an offer within 24 hours.'
  || CASE WHEN beds <> '' AND baths <> ''
     THEN chr(10) || 'Property: ' || beds || ' Beds / ' || baths || ' Baths' ELSE '' END
ELSE
  CASE WHEN consumer_name <> '' THEN 'Hi ' || consumer_name || ', ' ELSE '' END
  || 'Congratulations! I''m connecting you with ' || agent_name
  || ', who''ll be helping you with your cash offer. ' || {AVAILABILITY}
  || chr(10) || chr(10) || agent_name
  || ' is excited to get started and can often deliver an offer within 24 hours.'
  || chr(10) || chr(10) || 'Please reply "Yes" to confirm you''ve received this message.' END)
"""
LEAD_VALID = (
    "consumer_phone <> '' AND agent_name <> '' AND agent_phone <> ''"
    " AND (NOT coalesce(use_first_selection_logic, TRUE) OR address_line <> '')"
)
