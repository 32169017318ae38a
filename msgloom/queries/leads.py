"""Queries on leads (from ``customer``), messages and replies (from ``conversations``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom import config
from msgloom.functions import messages
from msgloom.functions import text as X
from msgloom.operators import classify, dedup, joins, rows, shape
from msgloom.plans import leads as job
from msgloom.plans import replies
from msgloom.queries.registry import query
from msgloom.queries.sql import (
    AVAILABILITY,
    LEAD_CTES,
    LEAD_VALID,
    SLOT_PICK,
    THREE_WAY,
    id_sql,
)
from msgloom.queries.tables import AS_OF, lead_phone, leads, table, text, webhooks
from msgloom.schemas import SENT_MESSAGE, WEBHOOK
from msgloom.session import shared_dir
from msgloom.sources import readers

SENDER = "+15550199"


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.lead_normalise(leads(spark, sf_dir))


_LEAD_COLUMNS = (
    "consumer_name, consumer_phone, agent_name, agent_phone, address_line, zip_code, beds, "
    "baths, is_flexible, message, use_first_selection_logic, " + ", ".join(config.SLOTS)
)


@query(f"WITH {LEAD_CTES} SELECT {_LEAD_COLUMNS} FROM lead")
def lead_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal(spark, sf_dir)


@query(f"""
WITH {LEAD_CTES}
SELECT 'agent' AS receiver, consumer_phone, CAST(NULL AS VARCHAR) AS address_line,
  weekdays_morning FROM lead
UNION ALL SELECT 'three_way', consumer_phone, address_line, weekdays_morning FROM lead
UNION ALL SELECT 'internal', consumer_phone, address_line, weekdays_morning FROM lead
""")
def request_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each receiver is sent; the agent's request has no address."""
    normal = _normal(spark, sf_dir)
    parts = [
        job.request_projection(normal, receiver).withColumn("receiver", F.lit(receiver))
        for receiver in job.REQUESTS
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select("receiver", "consumer_phone", "address_line", "weekdays_morning")


@query(f"""
WITH {LEAD_CTES} SELECT n AS c_custkey, phone,
  CASE WHEN phone = '' THEN phone
       WHEN regexp_replace(phone, '[^0-9]', '', 'g') = '' THEN NULL
       ELSE '+1' || regexp_replace(regexp_replace(phone, '[^0-9]', '', 'g'), '^1', '')
  END AS normal
FROM given
""")
def phone_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "customer").select("c_custkey", lead_phone().alias("phone"))
    return kept.select(
        "c_custkey", "phone", X.us_phone(F.col("phone")).alias("normal")
    )


@query(f"WITH {LEAD_CTES} SELECT agent_name, consumer_name, {SLOT_PICK} AS slot FROM lead")
def first_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = _normal(spark, sf_dir)
    slot = messages.first_true_slot(job.slot_flags(normal))
    return normal.select("agent_name", "consumer_name", slot.alias("slot"))


@query(f"WITH {LEAD_CTES} SELECT message, {AVAILABILITY} AS sentence FROM lead")
def availability_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = _normal(spark, sf_dir)
    sentence = messages.availability_sentence(job.slot_flags(normal))
    return normal.select("message", sentence.alias("sentence"))


@query(f"""
WITH {LEAD_CTES}
SELECT consumer_phone, {THREE_WAY} AS three_way_text,
  CASE WHEN consumer_name <> '' AND address_line <> '' AND zip_code <> '' AND beds <> ''
    AND baths <> '' THEN
    'Hi ' || split_part(agent_name, ' ', 1) || ',' || chr(10) || chr(10)
    || 'You''ve got a cash offer appointment scheduled with ' || consumer_name || ' at '
    || address_line || ', ' || zip_code || '.' || chr(10) || chr(10)
    || 'Property: ' || beds || ' Beds / ' || baths || ' Baths' || chr(10)
    || 'Appointment Window: ' || {SLOT_PICK} || chr(10) || chr(10)
    || 'Please text the homeowner the time you will arrive and confirm. '
    || 'There''s no need to ask for their availability — the appointment has already been set.'
  END AS agent_text,
  CASE WHEN consumer_name <> '' AND address_line <> '' AND zip_code <> '' THEN
    'New appointment confirmed.' || chr(10) || consumer_name || ' (' || consumer_phone || ')'
    || chr(10) || address_line || ', ' || zip_code || chr(10) || 'Agent: ' || agent_name || ' '
    || chr(10) || 'Phone: (' || agent_phone || ')' || chr(10) || 'Time: ' || {SLOT_PICK} || '.'
  END AS internal_text,
  'Conversation between ' || coalesce(nullif(consumer_name, ''), consumer_phone) || ' and '
    || agent_name AS friendly_name,
  'agent:' || agent_phone AS chat_identity
FROM lead WHERE {LEAD_VALID}
""")
def render_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three texts of every valid lead."""
    rendered, _ = job.render(_normal(spark, sf_dir))
    return rendered.select(
        "consumer_phone", "three_way_text", "agent_text", "internal_text", "friendly_name",
        "chat_identity",
    )


@query(f"""
WITH {LEAD_CTES},
base AS (SELECT *, consumer_phone <> '' AND agent_name <> '' AND agent_phone <> '' AS complete
         FROM lead)
SELECT consumer_phone, agent_name, 'Missing required fields: ' || concat_ws(', ',
  CASE WHEN NOT coalesce(consumer_phone <> '', FALSE) THEN 'consumer_phone' END,
  CASE WHEN NOT coalesce(agent_name <> '', FALSE) THEN 'agent_name' END,
  CASE WHEN coalesce(complete, FALSE) THEN 'address_line' END) AS reason
FROM base WHERE NOT coalesce({LEAD_VALID}, FALSE)
""")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads that cannot be sent, with what they lack."""
    _, invalid = job.render(_normal(spark, sf_dir))
    return invalid.select("consumer_phone", "agent_name", "reason")


_MESSAGE_KEYS = ("'2024-02-01T00:00:00.000000'", "consumer_phone", "agent_phone", "msg", "copy")
_SENT_SQL = f"""
WITH {LEAD_CTES},
valid AS (SELECT *, {THREE_WAY} AS msg FROM lead WHERE {LEAD_VALID}),
ids AS (
  SELECT *, {id_sql("'message'", *_MESSAGE_KEYS)} AS sid,
    {id_sql("'conversation'", *_MESSAGE_KEYS)} AS conv
  FROM (SELECT *, row_number() OVER (PARTITION BY consumer_phone, agent_phone, msg) AS copy
        FROM valid)),
both_rows AS (SELECT *, consumer_phone AS recipient FROM ids
         UNION ALL SELECT *, agent_phone FROM ids)
"""
_SENT_COLUMNS = """
  sid AS message_sid, conv AS conversation_sid, msg AS text_send, consumer_name AS customer_name,
  '+15550199' AS sender_number, '2024-02-01T00:00:00.000000' AS received_at, '0' AS media_count,
  'outbound-api' AS direction, CAST(NULL AS VARCHAR) AS recipient_country,
  CAST(NULL AS VARCHAR) AS recipient_state, CAST(NULL AS VARCHAR) AS sender_zip,
  CAST(NULL AS VARCHAR) AS sender_state, CAST(NULL AS VARCHAR) AS sender_city,
  CAST(NULL AS VARCHAR) AS sender_country, recipient AS recipient_number
"""


@query(f"""
{_SENT_SQL} SELECT {_SENT_COLUMNS}, sid || '-' || replace(recipient, '+', '') AS log_key
FROM both_rows
""")
def recipient_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sent log: two rows per message."""
    rendered, _ = job.render(_normal(spark, sf_dir))
    return job.sent_log(rendered, SENDER, AS_OF)


@query(f"{_SENT_SQL} SELECT {_SENT_COLUMNS} FROM both_rows")
def leads_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on files, run twice: the second run replaces the first one's rows."""
    base = shared_dir(spark, "leads")
    paths = [f"{base}/{n}" for n in ("sent", "rejected", "log")]
    for _ in range(2):
        job.run(spark, leads(spark, sf_dir), *paths, SENDER, dt.datetime(2024, 2, 1))
    return readers.read_layer(spark, paths[0]).select(*SENT_MESSAGE.fieldNames())


@query(f"""
{_SENT_SQL}
SELECT recipient AS recipient_number, sid AS message_sid FROM both_rows
QUALIFY row_number() OVER (PARTITION BY recipient ORDER BY sid DESC) = 1
""")
def current_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered, _ = job.render(_normal(spark, sf_dir))
    sent = job.sent_log(rendered, SENDER, AS_OF)
    return job.current_conversations(sent).select("recipient_number", "message_sid")


@query("""
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS name, c_mktsegment AS segment
FROM customer
""")
def struct_fields_win(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct's fields lifted to the top replace columns of the same name."""
    nested = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.struct(
            F.col("c_nationkey").cast("string").alias("name"),
            F.col("c_mktsegment").alias("segment"),
        ).alias("inner"),
    )
    return shape.flatten_struct_into(nested, "inner")


# --- replies -----------------------------------------------------------------------
_TURNS = "(SELECT * FROM conversations WHERE role = 'user')"
_CREATED = "make_timestamp(1704067200000000 + (conv_id % 366 * 86400 + turn * 60) * 1000000)"


@query(f"""
SELECT CASE WHEN conv_id % 4 <> 0 THEN 'US' END AS recipient_country, 'WA' AS recipient_state,
  '98' || (conv_id % 100) AS sender_zip, CASE WHEN conv_id % 3 <> 0 THEN 'CA' END AS sender_state,
  CAST(NULL AS VARCHAR) AS sender_city, CAST(NULL AS VARCHAR) AS sender_country,
  text AS reply_text, 'IM' || conv_id || '-' || turn AS message_sid,
  '+15550199' AS recipient_number, '+1555' || conv_id AS sender_number, '0' AS media_count,
  '2024-02-01T00:00:00.000Z' AS received_at
FROM {_TURNS}
""")
def reply_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.reply_projection_sms(webhooks(spark, sf_dir), AS_OF)


_CONVERSATION_SQL = f"""
SELECT 'CH' || conv_id AS conversation_sid, {", ".join(f"'' AS {c}" for c in replies.BLANK)},
  strftime({_CREATED}, '%d') AS day, strftime({_CREATED}, '%m') AS month,
  strftime({_CREATED}, '%Y') AS year, 'inbound' AS direction, '0' AS media_count,
  'IM' || conv_id || '-' || turn AS message_sid, '2024-02-01T00:00:00.000Z' AS received_at,
  CASE WHEN conv_id % 4 <> 0 THEN 'US' END AS sender_country, '+1555' || conv_id AS sender_number,
  text AS text_send, 'received' AS delivery_status
FROM {_TURNS}
"""


@query(_CONVERSATION_SQL)
def reply_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.reply_projection_conversation(webhooks(spark, sf_dir), AS_OF)


@query(f"""
SELECT 'sms' AS output, 'IM' || conv_id || '-' || turn AS message_sid, text,
  '+1555' || conv_id AS sender_number, '2024' AS year, '02' AS month, '01' AS day
FROM {_TURNS}
UNION ALL
SELECT 'conversation', 'IM' || conv_id || '-' || turn, text, '+1555' || conv_id,
  strftime({_CREATED}, '%Y'), strftime({_CREATED}, '%m'), strftime({_CREATED}, '%d')
FROM {_TURNS}
""")
def reply_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored requests filed as two outputs; taking them in again leaves each row once."""
    base = shared_dir(spark, "replies")
    webhooks(spark, sf_dir).write.json(f"{base}/requests")
    requests = readers.read_webhook_payloads(spark, f"{base}/requests")
    for _ in range(2):
        replies.intake(requests, f"{base}/sms", f"{base}/conversation", AS_OF, "first")
    names = {"sms": "reply_text", "conversation": "text_send"}
    found = [
        spark.read.schema(
            f"message_sid STRING, {text_column} STRING, sender_number STRING, run STRING, "
            "year STRING, month STRING, day STRING"
        )
        .json(f"{base}/{output}")
        .select(F.lit(output).alias("output"), "message_sid", F.col(text_column).alias("text"),
                "sender_number", "year", "month", "day")
        for output, text_column in names.items()
    ]
    return rows.recombine(*found)


def _talk(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").filter(F.col("role") == role)
    return talks.select("conv_id", "turn", "text")


@query("""
SELECT conv_id, turn, text AS text_send, CAST(NULL AS VARCHAR) AS reply_text FROM conversations
WHERE role = 'assistant'
UNION ALL
SELECT conv_id, turn, NULL, text FROM conversations WHERE role = 'user'
""")
def conversation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _talk(spark, sf_dir, "assistant").withColumnRenamed("text", "text_send")
    answers = _talk(spark, sf_dir, "user").withColumnRenamed("text", "reply_text")
    return rows.conversation_log(sent, answers)


_REPLY_SQL = """
SELECT u.conv_id, u.turn, u.text,
  arg_max(s.text, s.turn) AS sent_text, max(s.turn) AS sent_turn
FROM (SELECT conv_id, turn, text FROM conversations WHERE role = 'user') u
LEFT JOIN (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant') s
  ON s.conv_id = u.conv_id AND s.turn <= u.turn
GROUP BY ALL
"""


@query(_REPLY_SQL)
def reply_to_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant's last turn before it, in few pieces."""
    return joins.reply_to_sent(
        _talk(spark, sf_dir, "assistant"), _talk(spark, sf_dir, "user"), "conv_id", "turn", "turn",
        {"text": "sent_text", "turn": "sent_turn"}, pieces=4,
    )


@query(_REPLY_SQL)
def reply_to_sent_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with conversations cut into pieces of about as many rows."""
    return joins.reply_to_sent(
        _talk(spark, sf_dir, "assistant"), _talk(spark, sf_dir, "user"), "conv_id", "turn", "turn",
        {"text": "sent_text", "turn": "sent_turn"},
    )


@query("""
SELECT conv_id, turn, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1
""")
def last_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return dedup.latest_per_key(talks, "conv_id", ["turn"])


@query("""
SELECT 'IM' || conv_id || '-' || turn AS message_sid,
  '{"headers":{' || CASE WHEN conv_id % 2 = 0 THEN '"cf-ipcountry":"US"' ELSE '' END || '}}'
    AS request
FROM conversations WHERE role = 'user'
""")
def webhook_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as JSON text, parsed and rendered again."""
    conv = F.col("conv_id")
    head = F.when(conv % 2 == 0, F.lit('"cf-ipcountry":"US"')).otherwise("")
    sid = F.concat(text("IM", conv), F.lit("-"), F.col("turn").cast("string"))
    raw = _turns(spark, sf_dir).select(
        sid.alias("message_sid"),
        F.concat(F.lit('{"unknown": 1, "headers": {'), head, F.lit("}}")).alias("raw"),
    )
    parsed = raw.withColumn("parsed", X.parse_json(F.col("raw"), WEBHOOK))
    return parsed.select("message_sid", X.json_of(F.col("parsed")).alias("request"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.filter_in(table(spark, sf_dir, "conversations"), "role", ["user"])
