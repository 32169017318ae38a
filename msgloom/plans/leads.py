"""Leads: normalise, check, render the three texts and log what is sent."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from msgloom import config
from msgloom.functions import messages
from msgloom.functions.text import identity, log_key, row_id, text_true, us_phone
from msgloom.functions.times import When, date_parts, moment
from msgloom.operators import aggregate, classify, dedup, rows, shape
from msgloom.schemas import SENT_MESSAGE
from msgloom.sinks import writers

REQUIRED = ("consumer_phone", "agent_name", "agent_phone")
AGENT_REQUIRED = ("agent_name", "agent_phone", "consumer_name", "address_line", "zip_code",
                  "beds", "baths")
INTERNAL_REQUIRED = ("consumer_name", "consumer_phone", "address_line", "zip_code",
                     "agent_name", "agent_phone")

# Fields each receiver is sent.
_SHORT = ("consumer_phone", "consumer_name", "agent_name", "agent_phone", "is_flexible", "message")
_FULL = ("consumer_phone", "consumer_name", "agent_name", "address_line", "zip_code", "beds",
         "baths", "agent_phone", "is_flexible", "message")
REQUESTS = {
    "agent": (*_SHORT, *config.SLOTS),
    "three_way": (*_FULL, *config.SLOTS),
    "internal": (*_FULL, *config.SLOTS),
}


def lead_normalise(leads: DataFrame) -> DataFrame:
    """Flat lead with consumer names, ``+1`` phones and true flags; the old names are gone."""
    flat = shape.flatten_struct_into(leads, "availability")
    named = shape.rename_map(
        flat,
        {
            "name": "consumer_name",
            "phone": "consumer_phone",
            "address_line_1": "address_line",
        },
    )
    flags = {s: text_true(F.col(s)) for s in config.SLOTS if s in named.columns}
    return named.withColumns(
        {
            "consumer_phone": us_phone(F.col("consumer_phone")),
            "agent_phone": us_phone(F.col("agent_phone")),
            "is_flexible": text_true(F.col("is_flexible")),
            **flags,
        }
    )


def request_projection(leads: DataFrame, receiver: str) -> DataFrame:
    """The reduced payload for one receiver."""
    return leads.select(*REQUESTS[receiver])


def slot_flags(df: DataFrame) -> dict[str, Column]:
    return {s: F.col(s) for s in config.SLOTS if s in df.columns}


def three_way_text(df: DataFrame, use_first: Column, turnaround: str = "24 hours") -> Column:
    """The appointment text, or the introduction where the flag says so; true by default."""
    flags = slot_flags(df)
    c = F.col
    return F.when(
        F.coalesce(use_first, F.lit(True)),
        messages.appointment_text(
            c("consumer_name"),
            c("agent_name"),
            c("agent_phone"),
            c("address_line"),
            messages.first_true_slot(flags),
            c("beds"),
            c("baths"),
        ),
    ).otherwise(
        messages.introduction_text(
            c("consumer_name"),
            c("agent_name"),
            messages.availability_sentence(flags),
            turnaround,
        )
    )


def _complete(columns: tuple[str, ...]) -> Column:
    return F.size(classify.missing_fields(columns)) == 0


def render(leads: DataFrame, turnaround: str = "24 hours") -> tuple[DataFrame, DataFrame]:
    """Valid leads with their texts, and the others with the reason.

    Everything is checked before a message exists: the appointment text needs an address.
    The media form of the introduction says ``just 24 hours`` for its turnaround.
    The agent and office texts are null where a field of theirs is missing, and
    ``agent_missing`` and ``internal_missing`` name it.
    """
    use_first = F.coalesce(F.col("use_first_selection_logic"), F.lit(True))
    required, invalid = classify.require_fields(leads, REQUIRED)
    no_address = use_first & (F.size(classify.missing_fields(["address_line"])) > 0)
    invalid = invalid.unionByName(
        required.filter(no_address).withColumn(
            "reason", F.lit("Missing required fields: address_line")
        )
    )
    c = F.col
    slot = messages.first_true_slot(slot_flags(leads))
    agent = messages.agent_text(
        c("agent_name"), c("consumer_name"), c("address_line"), c("zip_code"),
        c("beds"), c("baths"), slot,
    )
    office = messages.internal_text(
        c("consumer_name"), c("consumer_phone"), c("address_line"), c("zip_code"),
        c("agent_name"), c("agent_phone"), slot,
    )
    rendered = required.filter(~no_address).withColumns(
        {
            "friendly_name": messages.friendly_name(
                c("consumer_name"), c("consumer_phone"), c("agent_name")
            ),
            "chat_identity": identity(c("agent_phone")),
            "appointment_time": slot,
            "three_way_text": three_way_text(leads, use_first, turnaround),
            "agent_text": F.when(_complete(AGENT_REQUIRED), agent),
            "agent_missing": classify.missing_fields(AGENT_REQUIRED),
            "internal_text": F.when(_complete(INTERNAL_REQUIRED), office),
            "internal_missing": classify.missing_fields(INTERNAL_REQUIRED),
        }
    )
    return rendered, invalid


def sent_log(
    rendered: DataFrame, sender_number: str, sent_at: When, message_sid: Column | None = None
) -> DataFrame:
    """Two rows per message, one for each recipient, with the key each is filed under.

    Without ids from a message service, stable ones are made from time, phones and text;
    equal messages of one batch are numbered, so that each has its own.
    """
    parts = ("consumer_phone", "agent_phone", "three_way_text")
    received = F.date_format(moment(sent_at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    copy = F.row_number().over(Window.partitionBy(*parts).orderBy(F.lit(1)))
    keys = (received, *map(F.col, parts), F.col("_copy"))
    sid = message_sid if message_sid is not None else row_id(F.lit("message"), *keys)
    unknown = F.lit(None).cast("string")
    common = rendered.withColumn("_copy", copy).select(
        sid.alias("message_sid"),
        row_id(F.lit("conversation"), *keys).alias("conversation_sid"),
        F.col("three_way_text").alias("text_send"),
        F.col("consumer_name").alias("customer_name"),
        F.lit(sender_number).alias("sender_number"),
        received.alias("received_at"),
        F.lit("0").alias("media_count"),
        F.lit("outbound-api").alias("direction"),
        *[
            unknown.alias(c)
            for c in ("recipient_country", "recipient_state", "sender_zip", "sender_state",
                      "sender_city", "sender_country")
        ],
        "consumer_phone",
        "agent_phone",
    )
    both = rows.per_recipient_rows(common, ["consumer_phone", "agent_phone"])
    return both.select(
        *SENT_MESSAGE.fieldNames(),
        log_key(F.col("message_sid"), F.col("recipient_number")).alias("log_key"),
    )


def current_conversations(sent: DataFrame) -> DataFrame:
    """The conversation each recipient is in: a newer one replaces the older ones."""
    return dedup.latest_per_key(sent, "recipient_number", ["received_at", "message_sid"])


def run(
    spark: SparkSession,
    leads: DataFrame,
    sent_path: str,
    rejected_path: str,
    run_log: str,
    sender_number: str,
    as_of: dt.datetime,
) -> dict:
    """Render a batch of leads; sent rows are filed by day, rejected ones kept with the reason."""
    run_id = f"leads-{as_of:%Y%m%dT%H%M%S}"
    rendered, invalid = render(lead_normalise(leads))
    sent, seen = aggregate.row_counts(
        sent_log(rendered, sender_number, as_of), f"{run_id}-sent"
    )
    day = date_parts(moment(as_of))
    sent = sent.withColumns({**day, "run_id": F.lit(run_id)})
    writers.overwrite_partitions(sent, sent_path, [*day, "run_id"])
    bad, left = aggregate.row_counts(invalid, f"{run_id}-rejected")
    writers.overwrite_partitions(bad.withColumn("run_id", F.lit(run_id)), rejected_path, ["run_id"])
    metrics = {
        "sent_rows": aggregate.observed(seen).get("rows", 0),
        "rejected_rows": aggregate.observed(left).get("rows", 0),
    }
    writers.write_run_log(
        spark, run_log, run_id, "leads", as_of, metrics, metrics["sent_rows"]
    )
    return metrics
