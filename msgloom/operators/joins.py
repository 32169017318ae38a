"""Joins, without hints: Spark broadcasts a side once its measured size is small."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_with_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, dim_key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Facts with the dimension's columns (``{dimension column: new name}``), null if unknown.

    The dimension must hold each key once, or facts would multiply: a key that it holds more
    than once ends the job with an error once a fact meets it. The dimension is grouped by the
    join's own key, which a shuffle join needs as partitioning anyway. Null keys match nothing.
    """
    key_of = F.col(dim_key).alias("_dim_key")
    grouped = dimension.filter(F.col(dim_key).isNotNull()).groupBy(key_of).agg(
        F.any_value(F.struct(*[F.col(c).alias(n) for c, n in columns.items()])).alias("_row"),
        F.count(F.lit(1)).alias("_rows"),
    )
    found = facts.join(grouped, facts[key] == grouped["_dim_key"], "left")
    repeated = F.concat(F.lit(f"{dim_key} is not unique in the dimension: "), F.col("_dim_key").cast("string"))
    row = F.when(F.col("_rows") > 1, F.raise_error(repeated)).otherwise(F.col("_row"))
    named = [F.col("_row")[n].alias(n) for n in columns.values()]
    return found.withColumn("_row", row).select(*[F.col(f"`{c}`") for c in facts.columns], *named)


def time_buckets(df: DataFrame, at: str, pieces: int) -> Column:
    """A rising function of a time column that cuts the rows into about equal pieces.

    The cuts are approximate quantiles of the whole column: ``pieces`` values come to the
    driver. Where they fall affects the spread over tasks only, never the result.
    """
    shares = [i / pieces for i in range(1, pieces)]
    kind = df.schema[at].dataType
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        number = F.col(at).cast("timestamp").cast("double")
    elif isinstance(kind, (T.TimestampType, T.NumericType)):
        number = F.col(at).cast("double")
    else:
        raise TypeError(f"{at}: a time or number is needed, not {kind.simpleString()}")
    cuts = df.agg(F.percentile_approx(number, shares, 10_000)).first()[0] or []
    bounds = sorted(set(cuts))
    if not bounds:
        return F.lit(0)
    # The number of cuts below the value.
    return sum(
        (F.when(number > bound, 1).otherwise(0) for bound in bounds[1:]),
        F.when(number > bounds[0], 1).otherwise(0),
    )


def reply_to_sent(
    sent: DataFrame,
    replies: DataFrame,
    key: str,
    sent_time: str,
    reply_time: str,
    sent_columns: Mapping[str, str],
    pieces: int = 64,
) -> DataFrame:
    """Each reply with the latest message sent before or when it came, null if none.

    Both sides go through one window per conversation instead of a join that would pair
    every message with every reply. The window runs per conversation and time bucket, so
    that one conversation with a third of all rows is spread over many tasks; a small table
    with one row per conversation and bucket carries the last message over from earlier
    buckets, of which a conversation has ``pieces`` at most.
    """
    payload = F.struct(*[F.col(c).alias(n) for c, n in sent_columns.items()])
    names = list(sent_columns.values())
    reply_columns = replies.columns
    packed = F.struct(*[F.col(f"`{c}`") for c in reply_columns])
    left = sent.select(
        F.col(key).alias("_key"), F.col(sent_time).alias("_at"), payload.alias("_sent")
    )
    right = replies.select(
        F.col(key).alias("_key"), F.col(reply_time).alias("_at"), packed.alias("_reply")
    )
    both = left.unionByName(right, allowMissingColumns=True)
    both = both.filter(F.col("_key").isNotNull() | F.col("_reply").isNotNull())
    bucket = (time_buckets(both, "_at", pieces) if pieces > 1 else F.lit(0)).cast("long")
    # Replies without a conversation match nothing: they are spread out by their content.
    spread = F.when(F.col("_key").isNull(), F.xxhash64("_reply")).otherwise(bucket)
    placed = both.withColumn("_bucket", spread)

    # At one moment a message comes before a reply; two messages at once go by content.
    place = [F.col("_at"), F.col("_sent").isNull(), F.col("_sent")]
    here = (
        Window.partitionBy("_key", "_bucket")
        .orderBy(*place)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = F.last("_sent", ignorenulls=True).over(here)
    matched = placed.withColumn("_local", local).filter(F.col("_reply").isNotNull())

    last_sent = F.max(F.when(F.col("_sent").isNotNull(), F.struct("_at", "_sent")))
    known = both.filter(F.col("_key").isNotNull())
    spans = (
        known.withColumn("_bucket", bucket)
        .groupBy("_key", "_bucket")
        .agg(last_sent["_sent"].alias("_carried"))
    )
    before = (
        Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = spans.select(
        "_key", "_bucket", F.last("_carried", ignorenulls=True).over(before).alias("_before")
    )
    found = matched.join(carried, ["_key", "_bucket"], "left")
    sent_row = F.coalesce("_local", "_before")
    return found.select(
        *[F.col("_reply")[c].alias(c) for c in reply_columns],
        *[sent_row[n].alias(n) for n in names],
    )
