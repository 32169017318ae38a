"""SQL dump text to CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.functions.text import clean_line
from msgloom.operators import aggregate, sqldump
from msgloom.operators.classify import sql_tuple_predicate
from msgloom.session import shared_dir
from msgloom.sinks import writers
from msgloom.sources import dump_text
from msgloom.sources.readers import read_sql_dump


def clean_dump(
    spark: SparkSession,
    source: str,
    target: str,
    rejected: str,
    run_log: str,
    as_of: dt.datetime,
    columns: list[str] | None = None,
    compression: str | None = None,
) -> dict:
    """Dump rows as CSV with the dump's own header; lines that do not fit go to ``rejected``.

    Quoted values may reach over lines. The dump is parsed once, into a work folder that both
    outputs are written from; it is removed in the end. The CSV files are compressed if asked for.
    """
    columns = columns or sqldump.tuple_header(read_sql_dump(spark, source))
    if not columns:
        raise ValueError(f"no header line in {source}, and no columns given")
    run_id = f"dump-{as_of:%Y%m%dT%H%M%S}"
    work = shared_dir(spark, "dump-text")
    try:
        place = ("file", "block", "kind")
        pieces = dump_text.read_pieces(spark, source)
        in_part = F.col("kind") != dump_text.WHOLE
        parsed = sqldump.read_tuples(pieces, columns, "value", place, in_part)
        parsed.write.option("compression", "zstd").parquet(work)
        read = spark.read.parquet(work)
        parts = read.filter(in_part).withColumnRenamed("line", "value")
        over_blocks = sqldump.read_tuples(dump_text.joined_pieces(parts), columns)
        read = read.filter(~in_part).drop(*place).unionByName(over_blocks)
        good, bad = sqldump.rows_and_rejects(read, columns)
        good, kept = aggregate.row_counts(good, f"{run_id}-good")
        bad, left = aggregate.row_counts(bad, f"{run_id}-bad")
        writers.write_csv(good, target, compression=compression)
        writers.write_csv(bad, rejected, compression=compression)
    finally:
        writers.remove_folder(spark, work)
    metrics = {
        "rows": aggregate.observed(kept).get("rows", 0),
        "rejected": aggregate.observed(left).get("rows", 0),
    }
    writers.write_run_log(spark, run_log, run_id, "dump", as_of, metrics, metrics["rows"])
    return metrics


def mixed_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tuple lines without brackets and quotes, other lines as they are; blanks left out."""
    text = clean_line(F.col(line))
    is_tuple = sql_tuple_predicate(F.col(line))
    return lines.filter(text != "").select(
        F.when(is_tuple, sqldump.strip_tuple(F.col(line))).otherwise(text).alias(line),
        is_tuple.alias("cleaned"),
    )


def clean_mixed(
    spark: SparkSession, source: str, target: str, run_log: str, as_of: dt.datetime
) -> dict:
    """A file of CSV and tuple lines as CSV lines only."""
    run_id = f"mixed-{as_of:%Y%m%dT%H%M%S}"
    lines, seen = aggregate.row_counts(
        mixed_lines(read_sql_dump(spark, source)), run_id, cleaned=F.col("cleaned")
    )
    writers.write_lines(lines, target)
    found = aggregate.observed(seen)
    metrics = {
        "lines_processed": found.get("rows", 0),
        "lines_cleaned": found.get("cleaned", 0),
    }
    writers.write_run_log(
        spark, run_log, run_id, "mixed", as_of, metrics, metrics["lines_processed"]
    )
    return metrics
