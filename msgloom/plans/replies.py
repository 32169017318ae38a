"""Replies: stored webhook requests to two projections, each filed by its own time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.functions.times import When, moment
from msgloom.sinks import writers

COUNTRY_HEADER = "cf-ipcountry"
BLANK = ("customer_name", "customer_number", "agent_name", "agent_phone", "address_line",
         "beds", "baths", "recipient_country", "recipient_state", "sender_city",
         "sender_state", "sender_zip")
CONVERSATION_REPLY = (
    "conversation_sid", "customer_name", "customer_number", "agent_name", "agent_phone",
    "address_line", "beds", "baths", "day", "direction", "media_count", "message_sid",
    "received_at", "recipient_country", "recipient_state", "sender_city", "sender_country",
    "sender_number", "sender_state", "sender_zip", "text_send", "year", "delivery_status",
    "month",
)


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def reply_projection_sms(requests: DataFrame, as_of: When) -> DataFrame:
    """The 12 fields of a reply that came as a plain text message."""
    names = {
        "recipient_state": "ToState",
        "sender_zip": "FromZip",
        "sender_state": "FromState",
        "sender_city": "FromCity",
        "sender_country": "FromCountry",
        "reply_text": "Body",
        "message_sid": "SmsMessageSid",
        "recipient_number": "To",
        "sender_number": "From",
        "media_count": "NumMedia",
    }
    return requests.select(
        F.col("headers")[COUNTRY_HEADER].alias("recipient_country"),
        *[F.col("body")[field].alias(name) for name, field in names.items()],
        _iso(moment(as_of)).alias("received_at"),
    )


def reply_projection_conversation(requests: DataFrame, as_of: When) -> DataFrame:
    """The 24 fields of a reply within a conversation; some are constants, some blank."""
    body = F.col("body")
    created = body["DateCreated"].try_cast("timestamp")
    fields = {
        **{name: F.lit("") for name in BLANK},
        "conversation_sid": body["ConversationSid"],
        "day": F.date_format(created, "dd"),
        "month": F.date_format(created, "MM"),
        "year": F.date_format(created, "yyyy"),
        "direction": F.lit("inbound"),
        "media_count": F.lit("0"),
        "message_sid": body["MessageSid"],
        "received_at": _iso(moment(as_of)),
        "sender_country": F.col("headers")[COUNTRY_HEADER],
        "sender_number": body["Author"],
        "text_send": body["Body"],
        "delivery_status": F.lit("received"),
    }
    return requests.select(*[fields[name].alias(name) for name in CONVERSATION_REPLY])


def intake(
    requests: DataFrame, sms_path: str, conversation_path: str, as_of: When, run_id: str
) -> None:
    """Both projections of one batch of requests, written once each.

    Text messages are filed by the time they were taken in, conversation replies by the
    time they were written, both below the run's own folder: taking the same batch in
    again under its id replaces it.
    """
    writers.fan_out(
        requests,
        [
            (
                lambda df: reply_projection_sms(df, as_of),
                lambda df: writers.write_partitioned_by_time(
                    df.withColumn("_taken", moment(as_of)),
                    "_taken",
                    f"{sms_path}/run={run_id}",
                    "overwrite",
                ),
            ),
            (
                lambda df: reply_projection_conversation(df, as_of),
                lambda df: writers.compact(df, "year", "month", "day")
                .write.mode("overwrite")
                .partitionBy("year", "month", "day")
                .json(f"{conversation_path}/run={run_id}"),
            ),
        ],
    )
