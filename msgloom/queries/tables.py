"""The given tables, and landing records that Spark derives from them.

The derived records have one row per row of their table (some twice, to have repeats), so
they grow with it. The same derivations in SQL are in ``sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom import config
from msgloom.operators import shape
from msgloom.schemas import LEAD, MESSAGE_EVENT, NOTIFICATION, WEBHOOK

AS_OF = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Times are compared as UTC, so the session zone is set to it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utc(ts: Column) -> Column:
    """A zoneless table time as a moment."""
    return ts.cast("timestamp")


def k_of(props: Column) -> Column:
    """The number in an event's properties."""
    return F.get_json_object(props, "$.k").cast("int")


def with_k(events: DataFrame) -> DataFrame:
    """Events with that number as ``k``, read from the text once."""
    return shape.compute_once(events, "k", k_of(F.col("props")))


def twice(df: DataFrame, when: Column) -> DataFrame:
    """Rows that meet the test come two times."""
    copies = F.when(when, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def message_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as message-event documents with their landing day."""
    events = with_k(table(spark, sf_dir, "events"))
    k, user = F.col("k"), F.col("user_id")
    kind = F.col("event_type")
    code = (
        F.when(k % 25 == 24, "QQQQQQ")
        .when(kind == "click", "Uv32rW")
        .when(kind == "view", "SGB8Vt")
        .when(kind == "signup", "XsRJQh")
        .when(kind == "error", "Y5SMsU")
        .when(k % 2 == 0, "SBXSA5")
        .otherwise("S5A6iQ")
    )
    extra = F.struct(
        F.lit(None).cast("string").alias("From City"),
        F.lit(None).cast("string").alias("From State"),
        F.lit("US").alias("From Country"),
        text("10.0.0.", k).alias("IP Address"),
        text("Extra ", k).alias("Message Body"),
    )
    given = {
        "To Number": text("+1555", user),
        "From Number": text("+1666", user),
        "Message Body": F.when(k % 4 != 0, text("Offer ", k)),
        "Message Name": text("Name ", k % 6),
        "Campaign Name": text("Campaign ", k % 7),
        "Bot Click": F.when(k % 7 != 0, k % 5 == 0),
        "$campaign": text("c", k % 7),
        "$message": F.when(k % 13 != 0, text("m", k % 10)),
        "Credits": F.when(k % 9 != 0, k % 4),
        "$usage_amount": k % 3,
        "$extra": extra,
    }
    properties = MESSAGE_EVENT["attributes"].dataType["event_properties"].dataType
    event_properties = F.struct(
        *[given.get(n, F.lit(None)).alias(n) for n in properties.fieldNames()]
    ).cast(properties)
    ts = F.col("ts")
    documents = events.select(
        "k",
        F.lit("event").alias("type"),
        text("e", F.col("event_id")).alias("id"),
        F.struct(
            F.unix_seconds(utc(ts)).cast("int").alias("timestamp"),
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("datetime"),
            text("u", F.col("event_id")).alias("uuid"),
            F.when(k % 22 != 0, text("p", user)).alias("profile_id"),
            event_properties.alias("event_properties"),
        ).alias("attributes"),
        F.struct(
            F.struct(F.struct(code.alias("id")).alias("data")).alias("metric"),
            F.struct(
                F.struct(F.when(k % 11 != 0, text("p", user)).alias("id")).alias("data")
            ).alias("profile"),
        ).alias("relationships"),
        F.year(ts).alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    )
    return twice(documents, F.col("k") % 10 == 3).drop("k")


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as notification records."""
    orders = table(spark, sf_dir, "orders")
    n = F.col("o_orderkey")
    queued = F.lit(1_704_067_200).cast("long") + F.dayofmonth("o_orderdate") * 86400
    stats = F.struct(
        *[
            (n % (i + 2)).alias(f)
            for i, f in enumerate(
                NOTIFICATION["platform_delivery_stats"].dataType.valueType.fieldNames()
            )
        ]
    )
    body = F.concat(
        text("Hi {{name}}, order ", n), F.when(n % 3 == 0, F.lit(" http://x.test/a")).otherwise("")
    )
    records = orders.select(
        text("n", n).alias("id"),
        F.lit("app").alias("app_id"),
        F.when(n % 9 != 0, text("Campaign ", F.col("o_orderpriority"))).alias("name"),
        F.when(n % 5 != 1, F.col("o_orderstatus") == "P").alias("canceled"),
        F.when(n % 13 != 0, F.create_map(F.lit("en"), body)).alias("contents"),
        F.when(n % 4 != 0, F.create_map(F.lit("en"), F.col("o_orderpriority"))).alias("headings"),
        F.when(n % 8 != 0, queued).alias("queued_at"),
        F.when(n % 16 != 0, queued + 3600).alias("completed_at"),
        F.when(n % 7 != 0, n % 50).alias("successful"),
        (n % 5).alias("failed"),
        F.when(n % 6 != 0, n % 3).alias("errored"),
        (n % 10).alias("converted"),
        F.when(n % 11 != 0, F.create_map(F.lit("ios"), stats)).alias("platform_delivery_stats"),
        F.when(n % 10 != 7, n % 3 == 1).alias("isSMS"),
        F.when(n % 10 != 9, n % 3 == 2).alias("isEmail"),
        F.lit("+15550100").alias("sms_from"),
        F.when(n % 2 == 0, text("Subject ", n)).alias("email_subject"),
        F.when(n % 12 == 0, F.array().cast("array<string>"))
        .when(n % 12 != 1, F.array(F.col("o_orderstatus"), F.lit("All")))
        .alias("included_segments"),
        F.when(n % 15 == 1, text("https://bit.ly/", n)).alias("url"),
        F.when(n % 15 == 2, text("https://w.test/", n)).alias("web_url"),
        F.when(n % 15 == 3, text("https://a.test/aff_ad/", n)).alias("app_url"),
        (n % 4).alias("priority"),
    )
    twofold = twice(records, F.substring("id", -1, 1) == "4")
    return shape.conform_to_schema(twofold, NOTIFICATION)


def lead_phone() -> Column:
    """A customer's phone, written in one of several ways or missing."""
    n = F.col("c_custkey")
    digits = F.lpad(n.cast("string"), 7, "0")
    return (
        F.when(n % 6 == 0, F.concat(F.lit("(555) "), digits))
        .when(n % 6 == 1, F.concat(F.lit("1555"), digits))
        .when(n % 6 == 2, F.concat(F.lit("+1-555-"), digits))
        .when(n % 60 == 3, F.lit(""))
        .when(n % 60 == 9, F.lit("none"))
        .when(n % 60 == 15, F.lit(None))
        .otherwise(F.concat(F.lit("555."), digits))
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as leads: phones in several forms, some fields missing, slots by bit."""
    customer = table(spark, sf_dir, "customer")
    n = F.col("c_custkey")
    slots = F.struct(
        *[
            F.when(F.shiftright(n, i).bitwiseAND(F.lit(5)) == 5, "true").otherwise("false").alias(s)
            for i, s in enumerate(config.SLOTS)
        ]
    )
    given = customer.select(
        F.when(n % 5 != 0, F.col("c_name")).alias("name"),
        lead_phone().alias("phone"),
        F.when(n % 40 != 7, text("Agent A", n % 17)).alias("agent_name"),
        F.concat(F.lit("1 555 02"), F.lpad((n % 17).cast("string"), 2, "0")).alias("agent_phone"),
        F.when(n % 30 != 11, text("Road ", n)).alias("address_line_1"),
        F.when(n % 9 != 0, text("98", n % 100)).alias("zip_code"),
        F.when(n % 4 != 1, (n % 5).cast("string")).alias("beds"),
        F.when(n % 8 != 1, (n % 3).cast("string")).alias("baths"),
        F.when(n % 2 == 0, "true").otherwise("no").alias("is_flexible"),
        F.col("c_mktsegment").alias("message"),
        F.when(n % 3 != 0, n % 3 == 1).alias("use_first_selection_logic"),
        slots.alias("availability"),
    )
    return shape.conform_to_schema(given, LEAD)


def webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of ``conversations`` as stored webhook requests, over the days of a year."""
    talks = table(spark, sf_dir, "conversations").filter("role = 'user'")
    conv, turn = F.col("conv_id"), F.col("turn")
    sid = F.concat(text("IM", conv), F.lit("-"), turn.cast("string"))
    created = F.timestamp_seconds(F.lit(1_704_067_200) + conv % 366 * 86400 + turn * 60)
    body = {
        "ToState": F.lit("WA"),
        "FromZip": text("98", conv % 100),
        "FromState": F.when(conv % 3 != 0, "CA"),
        "Body": F.col("text"),
        "SmsMessageSid": sid,
        "To": F.lit("+15550199"),
        "From": text("+1555", conv),
        "NumMedia": F.lit("0"),
        "ConversationSid": text("CH", conv),
        "MessageSid": sid,
        "Author": text("+1555", conv),
        "DateCreated": F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    }
    kind = WEBHOOK["body"].dataType
    return talks.select(
        F.when(conv % 4 != 0, F.create_map(F.lit("cf-ipcountry"), F.lit("US"))).alias("headers"),
        F.struct(*[body.get(n, F.lit(None)).alias(n) for n in kind.fieldNames()])
        .cast(kind)
        .alias("body"),
    )


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as rows of a dump, whose texts hold commas, quotes and signs."""
    orders = table(spark, sf_dir, "orders")
    n = F.col("o_orderkey")
    note = (
        F.when(n % 5 == 0, F.lit("NULL"))
        .when(n % 5 == 1, F.lit("'Check, then ship'"))
        .when(n % 5 == 2, F.lit("'It''s here'"))
        .when(n % 5 == 3, F.lit(r"'It\'s \"new\"'"))
        .otherwise(F.lit("''"))
    )
    row = F.concat_ws(
        ",",
        n.cast("string"),
        F.concat(F.lit("'"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("'")),
        F.concat(F.lit("'"), F.col("o_orderstatus"), F.lit("'")),
        note,
        (-F.col("o_custkey")).cast("string"),
    )
    end = F.when(n % 100 == 0, ");").otherwise("),")
    line = F.concat(F.lit("  ("), row, end)
    return shape.compute_once(orders, "value", line).select("value")


DUMP_COLUMNS = ["ticket", "opened", "state", "note", "account"]
