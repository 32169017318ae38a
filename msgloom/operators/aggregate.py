"""Counts, summaries, cursors and batch numbers (partial aggregates before each shuffle)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from msgloom.functions.numbers import exact_avg


def count_by(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(key).agg(F.count("*").alias(name))


def channel_summary(df: DataFrame, by: str = "message_type") -> DataFrame:
    """Sends, deliveries, clicks and average success rate per channel."""
    return df.groupBy(by).agg(
        F.sum("sends").alias("total_sends"),
        F.sum("delivered").alias("total_delivered"),
        F.sum("clicks").alias("total_clicks"),
        exact_avg(F.col("success_rate")).alias("avg_success_rate"),
    )


def next_batch_id(df: DataFrame, column: str = "batch_id", name: str = "batch_id") -> DataFrame:
    """One row with the highest number plus one; 1 for no rows, only nulls or no column."""
    if column not in df.columns:
        return df.sparkSession.range(1).select(F.lit(1).cast("long").alias(name))
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("long").alias(name))


def run_batch_counter(df: DataFrame, days: list[str], name: str = "batch_id") -> DataFrame:
    """The days that have rows, numbered from 1 in order.

    One row per calendar day, so the one-task numbering stays at thousands of rows at most
    however many rows a day has. Number the days of the *input*: a day whose rows are all
    filtered out later still takes its number.
    """
    present = df.select(*days).distinct()
    return present.withColumn(name, F.dense_rank().over(Window.orderBy(*days)).cast("int"))


def max_cursor(df: DataFrame, column: str, start: Column, name: str = "cursor") -> DataFrame:
    """One row with the highest position, or the old one if nothing came."""
    return df.agg(F.coalesce(F.max(column), start).alias(name))


def row_counts(
    df: DataFrame, name: str, **conditions: Column
) -> tuple[DataFrame, Observation]:
    """The same rows, with their number (and that of each condition) observed on the way.

    The counts come with the job that writes the frame; nothing is read a second time. Put
    this after the last shuffle: a stage that is run again there would count rows twice.
    """
    observation = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(test).alias(label) for label, test in conditions.items()]
    return df.observe(observation, *counts), observation


def observed(observation: Observation) -> dict:
    """What was observed; empty if no row came.

    Once adaptive execution finds a frame empty, it drops the frame's plan together with
    the observation, which then has no values to give.
    """
    try:
        return observation.get
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}


def lines_summary(df: DataFrame, cleaned: Column) -> DataFrame:
    """Lines processed and lines cleaned, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("lines_processed"), F.count_if(cleaned).alias("lines_cleaned")
    )
