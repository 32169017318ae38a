"""Decoding with the names that were valid at the time: intervals made of daily snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 32


def validity_intervals(
    snapshots: DataFrame, key: str, day: str, columns: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """key, valid_from, valid_to (exclusive, null: still valid) and the columns' values.

    A snapshot is the full list of its day. A record holds from its day to the next snapshot,
    whatever that one says: another value, the same (the intervals then become one) or no
    such key. Of several rows of a key and day the first by ``order`` counts, then the least
    values. Null keys and days are left out.
    """
    known = snapshots.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    values = F.struct(*columns)
    by_content = Window.partitionBy(key, day).orderBy(*order, *columns)
    once = known.withColumn("_n", F.row_number().over(by_content)).filter("_n = 1")
    # One row for each snapshot: the day after which it no longer counts.
    days = known.select(F.col(day).alias("_day")).distinct()
    next_day = F.lead("_day").over(Window.orderBy("_day")).alias("_until")
    dated = once.join(F.broadcast(days.select("_day", next_day)), F.col(day) == F.col("_day"))
    along = Window.partitionBy(key).orderBy(day)
    # A row goes on the interval before it if that ends on its day and has its values.
    goes_on = F.lag("_until").over(along).eqNullSafe(F.col(day)) & F.lag(values).over(along).eqNullSafe(values)
    marked = dated.withColumn("_new", F.when(goes_on, 0).otherwise(1))
    run = marked.withColumn("_run", F.sum("_new").over(along))
    last = F.max_by("_until", day)
    return run.groupBy(F.col(key).alias("key"), "_run").agg(
        F.min(day).alias("valid_from"), last.alias("valid_to"), *[F.first(c).alias(c) for c in columns]
    ).drop("_run")


def last_at_or_before(sorted_values: Column, value: Column, most: int) -> Column:
    """How many of the sorted values are not after the value, by binary search.

    ``most`` is the longest that the array may be.
    """
    steps = [1 << i for i in reversed(range(most.bit_length()))]

    def half(found: Column, step: Column) -> Column:
        there = F.get(sorted_values, found + step - 1)
        return F.when(F.coalesce(there <= value, F.lit(False)), found + step).otherwise(found)

    return F.aggregate(F.lit(steps), F.lit(0), half)


def decode_as_of(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    columns: Mapping[str, str],
    bucket_days: int = BUCKET_DAYS,
) -> DataFrame:
    """Facts with the columns (``{interval column: new name}``) valid on their day, else null.

    Time is cut into buckets of days. A key's intervals that reach into a bucket are one
    sorted array, which holds as many as the bucket has days at most, as snapshots are daily;
    so the join is on key and bucket, has one partner for a fact, and a binary search finds
    the interval. A key with a third of all facts is many join keys, and Spark splits the
    skewed ones or broadcasts the intervals if they are small.
    """
    names = list(columns.values())
    size = F.lit(bucket_days)
    first = F.floor(F.unix_date("valid_from") / size)
    # An open interval reaches as far as any fact does.
    horizon = facts.agg(F.max(F.to_date(at)).alias("_horizon"))
    reach = intervals.crossJoin(F.broadcast(horizon))
    until = F.coalesce(F.date_sub("valid_to", 1), F.greatest("_horizon", "valid_from"))
    buckets = F.sequence(first, F.floor(F.unix_date(until) / size))
    record = F.struct(
        "valid_from", "valid_to", *[F.col(c).alias(n) for c, n in columns.items()]
    ).alias("_record")
    spread = reach.select(F.col("key").alias("_key"), F.explode(buckets).alias("_bucket"), record)
    packed = spread.groupBy("_key", "_bucket").agg(F.array_sort(F.collect_list("_record")).alias("_records"))
    day = F.to_date(at)
    dated = facts.withColumn("_day", day).withColumn("_in", F.floor(F.unix_date("_day") / size))
    on = (F.col(f"`{key}`") == F.col("_key")) & (F.col("_in") == F.col("_bucket"))
    joined = dated.join(packed, on, "left")
    count = last_at_or_before(F.col("_records")["valid_from"], F.col("_day"), bucket_days + 1)
    found = F.get("_records", count - 1)
    valid = F.coalesce(found["valid_to"] > F.col("_day"), found["valid_to"].isNull())
    known = joined.withColumn("_found", F.when(valid, found))
    return known.select(*[F.col(f"`{c}`") for c in facts.columns], *[F.col("_found")[n].alias(n) for n in names])
