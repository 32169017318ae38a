"""Running numbers, day roll-ups."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from msgloom.operators import numbering, rollup
from msgloom.plans import landing

WHEN = dt.datetime(2024, 2, 1)


def test_numbers_run_through_all_tasks(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).filter("id % 10 <> 3 and (id < 200 or id > 500)")
    found = numbering.numbered(rows, str(tmp_path / "w")).orderBy("number").collect()
    assert [r["number"] for r in found] == list(range(1, len(found) + 1))
    assert [r["id"] for r in found] == sorted(r["id"] for r in found)


def test_numbers_of_no_rows_and_reserved_names(spark, tmp_path):
    assert numbering.numbered(spark.range(0), str(tmp_path / "w")).collect() == []
    with pytest.raises(ValueError, match="reserved"):
        numbering.numbered(spark.range(1).toDF("_place"), str(tmp_path / "v"))


def test_batch_numbers_run_through_a_run(spark):
    """Only the last document is not full; records come in order, those with maps as well."""
    records = spark.range(0, 997, 1, 5).select(
        F.col("id"), F.create_map(F.lit("en"), F.lit("x")).alias("texts")
    )
    documents = landing.envelopes(records, 50, "api", WHEN).collect()
    documents.sort(key=lambda d: d["metadata"]["batch_number"])
    assert [d["metadata"]["batch_number"] for d in documents] == list(range(1, 21))
    assert [len(d["data"]) for d in documents] == [50] * 19 + [47]
    assert [d["metadata"]["record_count"] for d in documents] == [50] * 19 + [47]
    assert [r["id"] for d in documents for r in d["data"]] == list(range(997))


def test_records_are_shuffled_once(spark):
    """Besides the records by document, only the totals of the tasks move."""
    records = spark.range(0, 997, 1, 5).withColumn("text", F.lit("x"))
    plan = landing.envelopes(records, 50, "api", WHEN)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if " Exchange " in line or "-Exchange" in line]
    kinds = ["hashpartitioning", "SinglePartition", "hashpartitioning"]  # records; totals in order; totals
    found = [next(k for k in (*kinds, "rangepartitioning") if k in line) for line in dealt]
    assert found == kinds, plan


def _figures(spark):
    n = F.col("id")
    return spark.range(0, 20000, 1, 4).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 10).cast("int")).alias("day"),
        F.when(n % 3 == 0, "SMS").when(n % 3 == 1, "EMAIL").alias("kind"),
        F.when(n % 7 != 0, n % 100).alias("sends"),
        F.when(n % 11 != 0, (n % 13) / 4).alias("rate"),
        (n % 4000).cast("string").alias("who"),
    )


def test_merged_parts_equal_a_full_count(spark, tmp_path):
    figures, path = _figures(spark), str(tmp_path / "parts")
    parts = rollup.day_parts(figures, "day", ["kind"], ["sends"], ["rate"], distinct="who", spread="sends")
    rollup.write_parts(parts, path, "day")
    # A day that is rolled up again replaces its part, and others stay.
    rollup.write_parts(parts.filter("day = '2024-01-04'"), path, "day")
    held = rollup.read_parts(spark, path, "day", "2024-01-03", "2024-01-08")
    assert held.count() == 6 * 3
    merged = {r["kind"]: r for r in rollup.merge_parts(held, ["kind"], [0.5, 0.9]).collect()}
    days = figures.filter("day between '2024-01-03' and '2024-01-08'")
    full = days.groupBy("kind").agg(
        F.count("*").alias("rows"),
        F.sum("sends").alias("sends"),
        (F.sum(F.col("rate").cast("decimal(38,8)")).cast("double") / F.count("rate")).alias("rate"),
        F.countDistinct("who").alias("who"),
        F.sort_array(F.collect_list("sends")).alias("sorted"),
    )
    for row in full.collect():
        found = merged[row["kind"]]
        assert (found["rows"], found["total_sends"], found["avg_rate"]) == (row["rows"], row["sends"], row["rate"])
        assert abs(found["distinct"] - row["who"]) <= 0.06 * row["who"]
        for q in (0.5, 0.9):
            value, ranked = found[f"q{round(q * 100)}"], row["sorted"]
            below = sum(v < value for v in ranked) / len(ranked)
            upto = sum(v <= value for v in ranked) / len(ranked)
            assert below - 0.03 <= q <= upto + 0.03


def test_a_range_opens_its_days_only(spark, tmp_path):
    path = str(tmp_path / "parts")
    rollup.write_parts(rollup.day_parts(_figures(spark), "day", ["kind"], ["sends"]), path, "day")
    held = rollup.read_parts(spark, path, "day", "2024-01-03", "2024-01-04")
    assert held.select("day").distinct().count() == 2
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "distinct" not in held.columns


def test_groups_without_values(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), None, None, None)], "day date, kind string, sends int, rate double")
    parts = rollup.day_parts(rows, "day", ["kind"], ["sends"], ["rate"], distinct="kind", spread="sends")
    found = rollup.merge_parts(parts, ["kind"], [0.5]).collect()[0]
    assert (found["rows"], found["total_sends"], found["avg_rate"], found["distinct"]) == (1, None, None, 0)
    assert rollup.merge_parts(parts.limit(0), ["kind"]).collect() == []
