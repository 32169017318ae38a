"""Streaming queries over files; each gives the rows of its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.operators import rows
from msgloom.plans import replies
from msgloom.queries.registry import query
from msgloom.queries.sql import tables_with_k
from msgloom.queries.tables import AS_OF, table, utc, webhooks, with_k
from msgloom.schemas import WEBHOOK
from msgloom.session import shared_dir
from msgloom.sources import page_files
from msgloom.streaming import late, matching, page_landing, streams, touches


def _event_files(spark: SparkSession, base: str, events: DataFrame) -> DataFrame:
    """Events as a stream of several files, two at a time."""
    events.repartition(6).write.parquet(f"{base}/in")
    return streams.read_files(
        spark, "parquet", f"{base}/in", events.schema, maxFilesPerTrigger=2
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", utc(F.col("ts")))


@query("SELECT event_id, event_type, value FROM events")
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files taken in by two runs of one query: no file is read twice."""
    base = shared_dir(spark, "stream-landing")
    events = _events(spark, sf_dir).select("event_id", "event_type", "value")
    records = _event_files(spark, base, events)
    for _ in range(2):
        streams.incremental_landing(records, f"{base}/out", f"{base}/checkpoint", ["event_type"])
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type", "value")


@query("SELECT event_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice in a stream, each id once in the output."""
    base = shared_dir(spark, "stream-dedup")
    events = _events(spark, sf_dir).select("event_id", "ts", "event_type")
    records = _event_files(spark, base, rows.recombine(events, events))
    once = streams.stream_dedup(records, "event_id", "ts", "60 days")
    streams.write_stream(once, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type")


@query("""
SELECT DISTINCT event_type, TRUE AS seen FROM events
""")
def stream_dedup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few ids, each in a fifth of all rows: copies are reduced per salt first."""
    base = shared_dir(spark, "stream-hot")
    records = _event_files(spark, base, _events(spark, sf_dir).select("event_type", "ts"))
    once = streams.stream_dedup(records, "event_type", "ts", "60 days", salts=8)
    streams.write_stream(once, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("event_type", F.lit(True).alias("seen"))


@query(f"""
WITH {tables_with_k()}
SELECT event_id, user_id, k FROM src WHERE event_type = 'click'
QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts, event_id) = 1
""")
def stream_first_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First clicks kept up to date while the files come in no order of time."""
    base = shared_dir(spark, "stream-touch")
    events = with_k(_events(spark, sf_dir))
    clicks = events.filter("event_type = 'click'").select("event_id", "ts", "user_id", "k")
    keys = ["user_id", "k"]
    records = _event_files(spark, base, clicks)
    streams.stream_first_touch(
        records, keys, ["ts", "event_id"], f"{base}/out", f"{base}/checkpoint"
    )
    return streams.read_first_touch(spark, f"{base}/out", keys).select("event_id", *keys)


@query("""
SELECT 'IM' || conv_id || '-' || turn AS message_sid, text AS reply_text, text AS text_send
FROM conversations WHERE role = 'user'
""")
def stream_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of webhook requests to both reply projections."""
    base = shared_dir(spark, "stream-replies")
    webhooks(spark, sf_dir).write.json(f"{base}/in")
    requests = streams.read_files(spark, "json", f"{base}/in", WEBHOOK)
    outputs = {
        f"{base}/sms": lambda df: replies.reply_projection_sms(df, AS_OF),
        f"{base}/conversation": lambda df: replies.reply_projection_conversation(df, AS_OF),
    }
    streams.write_two(requests, outputs, f"{base}/checkpoint")
    sms, talk = (spark.read.parquet(target) for target in outputs)
    return sms.select("message_sid", "reply_text").join(
        talk.select("message_sid", "text_send"), "message_sid"
    )


@query("""
SELECT r.event_id, s.event_id AS answered FROM events r
LEFT JOIN events s ON s.event_type = 'click' AND s.user_id = r.user_id AND s.ts <= r.ts
  AND s.ts >= r.ts - INTERVAL 2 DAY
WHERE r.event_type = 'purchase'
QUALIFY row_number() OVER (PARTITION BY r.event_id ORDER BY s.ts DESC NULLS LAST, s.event_id DESC) = 1
""")
def stream_reply_to_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with the user's last click of two days, as a join of two streams."""
    base = shared_dir(spark, "stream-replies-to-sent")
    events = _events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    sides = {}
    for kind in ("click", "purchase"):
        side = events.filter(F.col("event_type") == kind).drop("event_type")
        side.repartition(3).write.parquet(f"{base}/{kind}")
        # A row of the far future, in a later file, lets the watermark pass all others.
        end = spark.range(1).select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"),
                                    F.lit("2100-01-01").cast("timestamp").alias("ts"))
        end.write.mode("append").parquet(f"{base}/{kind}")
        sides[kind] = streams.read_files(spark, "parquet", f"{base}/{kind}", side.schema, maxFilesPerTrigger=2)
    found = matching.stream_reply_to_sent(
        sides["click"], sides["purchase"], "user_id", "ts", "ts", {"event_id": "answered"}, "2 days", "400 days"
    )
    streams.write_stream(found, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").filter("event_id >= 0").select("event_id", "answered")


@query("""
WITH m AS (SELECT max(ts) - INTERVAL 1 DAY AS behind FROM events),
again AS (SELECT CASE WHEN event_id % 3 = 0 THEN -event_id - 1 ELSE event_id END AS event_id, ts FROM events)
SELECT event_id, 'kept' AS output FROM events
UNION ALL SELECT event_id, 'kept' FROM again, m WHERE ts >= behind AND event_id < 0
UNION ALL SELECT event_id, 'late' FROM again, m WHERE ts < behind
""")
def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and, in a second micro-batch, all of them again, some under new ids: most are late."""
    base = shared_dir(spark, "stream-late")
    events = _events(spark, sf_dir).select("event_id", "ts")
    new = F.when(F.col("event_id") % 3 == 0, -F.col("event_id") - 1).otherwise(F.col("event_id"))
    for part in (events, events.withColumn("event_id", new)):
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    records = streams.read_files(spark, "parquet", f"{base}/in", events.schema, maxFilesPerTrigger=1)
    out = {name: f"{base}/{name}" for name in ("kept", "late")}
    late.stream_dedup_keeping_late(
        records, "event_id", "ts", "1 day", **out, marks=f"{base}/marks", checkpoint=f"{base}/checkpoint"
    )
    return rows.recombine(
        *[spark.read.parquet(p).select("event_id", F.lit(name).alias("output")) for name, p in out.items()]
    )


@query(f"""
WITH {tables_with_k()}
SELECT event_id, user_id, k FROM src WHERE event_type = 'click'
QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts, event_id) = 1
""")
def stream_first_touch_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First clicks with state that is dropped by timers, versions reduced to one for each key."""
    base = shared_dir(spark, "stream-touch-within")
    # A session of its own, as the state store is a setting.
    own = spark.newSession()
    own.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    events = with_k(_events(own, sf_dir))
    clicks = events.filter("event_type = 'click'").select("event_id", "ts", "user_id", "k")
    keys, order = ["user_id", "k"], ["ts", "event_id"]
    records = _event_files(own, base, clicks)
    target = f"{base}/out"
    touches.stream_first_touch_within(
        records, keys, order, "ts", "400 days", 86_400, target, f"{base}/checkpoint"
    )
    touches.compact_first_touch(own, target, keys, order)
    return touches.current_first_touch(spark, target, keys, order).select("event_id", *keys)


@query("SELECT event_id, event_type, value FROM events")
def paged_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages taken in by bookmark, in two runs: repeats over pages land once.

    Clicks stand in the pages of both runs, so that later pages hold earlier times and ids that
    were taken before.
    """
    base = shared_dir(spark, "paged-landing")
    events = _events(spark, sf_dir).select("event_id", "event_type", "value")
    clicks = events.filter("event_type = 'click'")
    for run, part in enumerate((clicks, events)):
        part.repartition(4).write.json(f"{base}/pages/run={run}")
        lines = page_files.stream_pages(spark, f"{base}/pages")
        found = page_files.records(lines, events.schema)
        paths = [f"{base}/{name}" for name in ("out", "filters", "work", "checkpoint")]
        page_landing.land_once(found, "event_id", ["page", "place"], *paths)
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type", "value")
