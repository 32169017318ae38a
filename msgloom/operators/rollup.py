"""Day roll-ups that merge: figures of any range of days from one small row per day and group.

A part holds sums and counts (exact), a HyperLogLog sketch of the distinct keys and a KLL
sketch of one value. Averages are kept as sum and count. A range is the union of its parts, so
that the rows themselves are read once, when their day is rolled up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.sinks import writers
from msgloom.sources import readers

# Precision of the distinct count: 2^LG_K cells; the error is about 1.04 / 2^(LG_K / 2).
LG_K = 12
# Size of the quantile sketch; the rank error is about 1.3 % of the rows at 200.
KLL_K = 200


def day_parts(
    df: DataFrame,
    day: str,
    by: Sequence[str],
    sums: Sequence[str],
    rates: Sequence[str] = (),
    distinct: str | None = None,
    spread: str | None = None,
) -> DataFrame:
    """One row per day and group: ``rows``, sums, sum and count of rates, and the sketches.

    Nulls are left out of sums, rates and sketches; a group without any value has null there.
    Rates are summed as decimals, so that parts and a full count agree to the last digit.
    """
    made = [F.count(F.lit(1)).alias("rows")]
    made += [F.sum(F.col(c).cast("long")).alias(f"total_{c}") for c in sums]
    for c in rates:
        made += [F.sum(F.col(c).cast("decimal(38,8)")).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
    if distinct:
        made.append(F.hll_sketch_agg(F.col(distinct), LG_K).alias("distinct_sketch"))
    if spread:
        made.append(F.kll_sketch_agg_bigint(F.col(spread).cast("long"), KLL_K).alias("spread_sketch"))
    return df.groupBy(day, *by).agg(*made)


def merge_parts(parts: DataFrame, by: Sequence[str], quantiles: Sequence[float] = ()) -> DataFrame:
    """The figures of all given parts by group, whatever days they are of.

    ``distinct`` and the quantiles (``q50`` for 0.5) are estimates, the rest is exact. Parts
    written without a sketch give no column for it.
    """
    made = [F.sum("rows").alias("rows")]
    shown = ["rows"]
    for c in parts.columns:
        if c.startswith("total_"):
            made.append(F.sum(c).alias(c))
            shown.append(c)
        if c.startswith("sum_"):
            rate = c.removeprefix("sum_")
            made.append((F.sum(c).cast("double") / F.sum(f"n_{rate}")).alias(f"avg_{rate}"))
            shown.append(f"avg_{rate}")
    if "distinct_sketch" in parts.columns:
        made.append(F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"))
        shown.append("distinct")
    if quantiles and "spread_sketch" in parts.columns:
        made.append(F.kll_merge_agg_bigint("spread_sketch").alias("_spread"))
        filled = F.kll_sketch_get_n_bigint("_spread") > 0  # an empty sketch has no quantiles
        for q in quantiles:
            value = F.kll_sketch_get_quantile_bigint("_spread", F.lit(q))
            shown.append(F.when(filled, value).alias(f"q{round(q * 100)}"))
    return parts.groupBy(*by).agg(*made).select(*by, *shown)


def write_parts(parts: DataFrame, path: str, day: str) -> None:
    """Put the parts of some days in place of those days' older parts; others stay."""
    writers.overwrite_partitions(writers.compact(parts, day), path, [day])


def read_parts(spark: SparkSession, path: str, day: str, first: str, last: str) -> DataFrame:
    """The parts from the first to the last day; only their folders are opened."""
    parts = readers.read_layer(spark, path)
    bounds = [F.lit(d).cast(parts.schema[day].dataType) for d in (first, last)]
    return parts.filter(F.col(day).between(*bounds))
