"""Running numbers without a task that sees all rows: prefix sums over one total per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, work: str, name: str = "number") -> DataFrame:
    """Rows numbered 1, 2, … without gaps, in the order of the tasks and of the rows in each.

    The rows are written to the ``work`` folder with their place (task, row in the task), as a
    task that runs again after a shuffle may hold its rows in another order. Then the rows of
    each task are counted on the places alone, and each task's first number is the sum of the
    counts before it. The table of these has one row per task that wrote rows and is broadcast;
    the rows themselves are not shuffled.
    """
    if {"_place", "_task", "_before", name} & set(df.columns):
        raise ValueError(f"reserved column names: _place, _task, _before, {name}")
    # The upper bits of this id are the task, the lower 33 the row within it.
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    placed.write.parquet(work)
    held = df.sparkSession.read.schema(placed.schema).parquet(work)
    task = F.shiftright("_place", 33).alias("_task")
    totals = held.groupBy(task).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    row = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        held.withColumn("_task", task)
        .join(F.broadcast(first), "_task")
        .withColumn(name, F.col("_before") + row + 1)
        .drop("_place", "_task", "_before")
    )
