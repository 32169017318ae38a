"""Queries on the notification job, whose records are derived from ``orders``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.config import Lineage
from msgloom.operators import aggregate, rollup, rows, shape
from msgloom.plans import landing
from msgloom.plans import notifications as job
from msgloom.queries.registry import query
from msgloom.queries.sql import NOTIFICATION_CTES, NOTIFICATION_UNIFIED
from msgloom.queries.tables import AS_OF, notifications
from msgloom.schemas import NOTIFICATION, OPTIMIZED_CAMPAIGN, UNIFIED
from msgloom.session import shared_dir
from msgloom.sources import readers

LINEAGE = Lineage(source="notices", connector_id="11", user_id="7001")
_RAW = ["id", "record_id", "eventtype", "content_text", "event_date", "processing_date",
        "batch_id", "source", "connector_id", "user_id", "queued_at_timestamp",
        "completed_at_timestamp", "send_after_timestamp"]


def _optimized(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = job.to_raw(notifications(spark, sf_dir), LINEAGE, AS_OF, 1)
    return job.to_optimized(raw, AS_OF, 1)


@query(f"""
WITH {NOTIFICATION_CTES}
SELECT id, record_id, eventtype, content_text, event_date, '20240201' AS processing_date,
  3 AS batch_id, 'notices' AS source, '11' AS connector_id, '7001' AS user_id,
  queued_ts AS queued_at_timestamp, completed_ts AS completed_at_timestamp,
  CAST(NULL AS TIMESTAMP) AS send_after_timestamp
FROM stamped
""")
def notifications_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.to_raw(notifications(spark, sf_dir), LINEAGE, AS_OF, 3).select(*_RAW)


@query(f"WITH {NOTIFICATION_CTES} SELECT {', '.join(OPTIMIZED_CAMPAIGN)} FROM campaigns")
def notifications_optimized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _optimized(spark, sf_dir)


@query(f"WITH {NOTIFICATION_CTES} {NOTIFICATION_UNIFIED}")
def notifications_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.to_unified(_optimized(spark, sf_dir), AS_OF, 1)


@query(f"""
WITH {NOTIFICATION_CTES}
SELECT message_type, CAST(sum(sends) AS BIGINT) AS total_sends,
  CAST(sum(delivered) AS BIGINT) AS total_delivered, CAST(sum(clicks) AS BIGINT) AS total_clicks,
  CAST(sum(CAST(success_rate AS DECIMAL(38, 8))) AS DOUBLE) / count(*) AS avg_success_rate
FROM campaigns GROUP BY message_type
""")
def channel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = job.to_raw(notifications(spark, sf_dir), LINEAGE, AS_OF, 1)
    return aggregate.channel_summary(job.channel_figures(raw))


_FIRST_DAY, _LAST_DAY = "2024-01-05", "2024-01-20"


@query(f"""
WITH {NOTIFICATION_CTES}
SELECT message_type, count(*) AS rows, CAST(sum(sends) AS BIGINT) AS total_sends,
  CAST(sum(delivered) AS BIGINT) AS total_delivered, CAST(sum(clicks) AS BIGINT) AS total_clicks,
  CAST(sum(CAST(success_rate AS DECIMAL(38, 8))) AS DOUBLE) / count(*) AS avg_success_rate,
  true AS reach_within_bound, true AS median_within_bound
FROM campaigns WHERE send_date BETWEEN DATE '{_FIRST_DAY}' AND DATE '{_LAST_DAY}'
GROUP BY message_type
""")
def channel_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of days out of stored day parts; sketches are held against a full count.

    The days from the middle of the range on are rolled up twice, which adds nothing.
    """
    figures = job.channel_figures(job.to_raw(notifications(spark, sf_dir), LINEAGE, AS_OF, 1))
    path = shared_dir(spark, "rollup")
    by, sums = ["message_type"], ["sends", "delivered", "clicks"]
    parts = rollup.day_parts(
        figures, "send_date", by, sums, ["success_rate"], distinct="campaign_id", spread="sends"
    )
    rollup.write_parts(parts, path, "send_date")
    rollup.write_parts(parts.filter("send_date >= '2024-01-12'"), path, "send_date")
    held = rollup.read_parts(spark, path, "send_date", _FIRST_DAY, _LAST_DAY)
    merged = rollup.merge_parts(held, by, [0.5])
    bounds = merged.select("message_type", "distinct", "q50")
    days = figures.filter(F.col("send_date").between(_FIRST_DAY, _LAST_DAY))
    exact = (
        days.join(bounds, "message_type")
        .groupBy("message_type")
        .agg(
            (F.abs(F.max("distinct") - F.countDistinct("campaign_id")) <= 0.06 * F.count("*") + 1)
            .alias("reach_within_bound"),
            ((F.count_if(F.col("sends") <= F.col("q50")) >= 0.46 * F.count("*"))
             & (F.count_if(F.col("sends") < F.col("q50")) <= 0.54 * F.count("*")))
            .alias("median_within_bound"),
        )
    )
    return merged.drop("distinct", "q50").join(exact, "message_type")


@query(f"""
WITH {NOTIFICATION_CTES}, day AS (SELECT * FROM stamped)
SELECT eventtype, count(*) AS events FROM day GROUP BY eventtype
""")
def event_type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = job.to_raw(notifications(spark, sf_dir), LINEAGE, AS_OF, 1)
    return aggregate.count_by(raw, "eventtype", "events")


@query("""
SELECT 'n' || o_orderkey AS id, 'ios' AS platform, CAST(o_orderkey % 2 AS INT) AS successful,
  CAST(o_orderkey % 3 AS INT) AS failed, CAST(o_orderkey % 11 AS INT) AS provider_errored
FROM orders WHERE o_orderkey % 11 <> 0
UNION ALL
SELECT 'n' || o_orderkey, 'ios', CAST(o_orderkey % 2 AS INT), CAST(o_orderkey % 3 AS INT),
  CAST(o_orderkey % 11 AS INT)
FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 10 = 4
""")
def platform_stats_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rows.explode_platform_stats(notifications(spark, sf_dir))
    return stats.select("id", "platform", "successful", "failed", "provider_errored")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = notifications(spark, sf_dir)
    return landing.envelopes(records, 2000, "api", AS_OF)


@query("""
SELECT 'n' || o_orderkey AS id, CAST(o_orderkey % 5 AS INT) AS failed, 'api' AS landing_source
FROM orders
UNION ALL
SELECT 'n' || o_orderkey, CAST(o_orderkey % 5 AS INT), 'api' FROM orders WHERE o_orderkey % 10 = 4
""")
def envelope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as capped pretty-printed documents and unwrapped again."""
    path = shared_dir(spark, "envelopes")
    landing.write_envelopes(_documents(spark, sf_dir), path)
    documents = readers.read_envelopes(spark, path, NOTIFICATION)
    return readers.unwrap_envelope(documents).select("id", "failed", "landing_source")


@query("""
SELECT 'records' AS part, CAST(count(*) + count(*) FILTER (o_orderkey % 10 = 4) AS BIGINT) AS held
FROM orders
UNION ALL SELECT 'documents over the cap', 0
UNION ALL SELECT 'documents that state another count', 0
UNION ALL SELECT 'documents under the cap, but for the last', 0
UNION ALL SELECT 'numbers that are missing or given twice', 0
""")
def envelope_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents hold what they state, none more than the cap, and are numbered without gaps."""
    documents = _documents(spark, sf_dir)
    number = F.col("metadata.batch_number")
    last = documents.agg(F.max(number).alias("last"))
    short = documents.join(F.broadcast(last)).filter((F.size("data") < 2000) & (number < F.col("last")))
    wrong = readers.envelope_mismatches(documents)
    counts = {
        "records": documents.agg(F.sum(F.size("data")).alias("held")),
        "documents over the cap": documents.agg(F.count_if(F.size("data") > 2000).alias("held")),
        "documents that state another count": wrong.agg(F.count("*").alias("held")),
        "documents under the cap, but for the last": short.agg(F.count("*").alias("held")),
        "numbers that are missing or given twice": documents.agg(
            (F.greatest(F.max(number), F.count("*")) - F.countDistinct(number)).alias("held")
        ),
    }
    return rows.recombine(
        *[count.select(F.lit(part).alias("part"), "held") for part, count in counts.items()]
    )


@query(f"WITH {NOTIFICATION_CTES} {NOTIFICATION_UNIFIED}")
def notifications_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on files, from landed documents to the table; it runs twice, adding nothing."""
    base = shared_dir(spark, "notifications")
    name = "msgloom_" + base.rsplit("-", 1)[1]
    layers = job.Layers(
        landing=f"{base}/landing",
        raw=f"{base}/raw",
        optimized=f"{base}/optimized",
        table=name,
        run_log=f"{base}/log",
        table_path=f"{base}/table",
    )
    landing.write_envelopes(_documents(spark, sf_dir), layers.landing)
    when = dt.datetime(2024, 2, 1)
    job.run(spark, layers, LINEAGE, when)
    job.run(spark, layers, LINEAGE, when)
    return shape.conform_to_schema(spark.table(name), UNIFIED)
