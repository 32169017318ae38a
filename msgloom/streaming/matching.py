"""Streams joined with streams: replies to the messages sent before them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_reply_to_sent(
    sent: DataFrame,
    replies: DataFrame,
    key: str,
    sent_time: str,
    reply_time: str,
    sent_columns: Mapping[str, str],
    within: str,
    delay: str,
    salts: int = 1,
) -> DataFrame:
    """Each reply with the latest message sent before or when it came, if ``within`` before it.

    A left outer join of two streams on the conversation and an interval of time, then the
    latest message of each reply. Both hold state for the interval and the delay only: a reply
    comes out once the watermark has passed it, with nulls if no message was found by then.
    The rows are those of ``joins.reply_to_sent`` with messages older than ``within`` left
    out, as long as no row is later than ``delay``.

    Replies must differ in some column; equal ones come out as one. Replies without a
    conversation match nothing; those without a time have no place in a stream and are left
    out. Of messages sent at one moment the last by content counts. Where one conversation
    may hold much of a stream, ``salts`` above 1 spreads its replies over as many tasks, at
    the price of as many copies of its messages.
    """
    names = list(sent_columns.values())
    columns = replies.columns
    content = F.struct(*[F.col(c).alias(n) for c, n in sent_columns.items()]).alias("_sent")
    left = replies.filter(F.col(reply_time).isNotNull()).withWatermark(reply_time, delay)
    right = sent.withWatermark(sent_time, delay).select(
        F.col(key).alias("_key"), F.col(sent_time).alias("_sent_at"), content
    )
    on = F.col(key) == F.col("_key")
    if salts > 1:
        whole = F.struct(*[F.col(f"`{c}`") for c in columns])
        left = left.withColumn("_salt", F.pmod(F.xxhash64(whole), F.lit(salts)))
        right = right.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        on &= F.col("_salt") == F.col("_copy")
    on &= F.col("_sent_at") <= F.col(reply_time)
    on &= F.col("_sent_at") >= F.col(reply_time) - F.expr(f"INTERVAL {within}")
    pairs = left.join(right, on, "leftOuter")
    last = F.max_by("_sent", F.struct("_sent_at", "_sent")).alias("_last")
    latest = pairs.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(last)
    return latest.select(*[F.col(f"`{c}`") for c in columns], *[F.col("_last")[n].alias(n) for n in names])
