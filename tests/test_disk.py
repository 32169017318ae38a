"""What jobs leave on the disks while they run."""

from __future__ import annotations

import datetime as dt
import gzip

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from msgloom.plans import dumps, landing
from msgloom.sinks import writers
from tests.llm.test_ngram_join import shuffle_files

WHEN = dt.datetime(2024, 2, 1)


@pytest.mark.parametrize("kind", ["append_layer", "overwrite_partitions", "append_table", "write_csv", "write_lines",
                                  "write_envelopes"])
def test_writers_free_their_shuffles(spark, tmp_path, kind):
    rows = spark.range(100).repartition("id").select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("v"))
    path, before = str(tmp_path / "out"), shuffle_files(spark)
    if kind == "append_layer":
        writers.append_layer(rows, path, "k")
    elif kind == "overwrite_partitions":
        writers.overwrite_partitions(rows, path, ["k"])
    elif kind == "append_table":
        writers.append_table(rows, f"disk_{tmp_path.name.replace('-', '_')}", ["k"], path)
    elif kind == "write_csv":
        writers.write_csv(rows, path)
    elif kind == "write_lines":
        writers.write_lines(rows, path, "v")
    else:
        one = rows.groupBy().agg(F.collect_list(F.struct("v")).alias("data"))
        writers_in = one.withColumn("metadata", F.struct(F.lit(1).alias("batch_number")))
        landing.write_envelopes(writers_in, path)
    assert not shuffle_files(spark) - before


def test_layers_are_compressed_alike(spark, tmp_path):
    rows = spark.range(10).select(F.lit("a").alias("k"), "id")
    writers.append_layer(rows, str(tmp_path / "layer"), "k")
    writers.append_table(rows, f"disk_{tmp_path.name.replace('-', '_')}", ["k"], str(tmp_path / "table"))
    files = [*tmp_path.glob("layer/k=a/*.parquet"), *tmp_path.glob("table/k=a/*.parquet")]
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_dump_in_compressed_files(spark, tmp_path):
    lines = [f"({n},'first\n\n(2,''x''),\n-- note {n}'),"  for n in range(40)] + ["(7),"]
    path = str(tmp_path / "in")
    writers.write_lines(spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1), path,
                        compression="gzip", max_records=8)
    assert len(list(tmp_path.glob("in/*.gz"))) == 6
    found = dumps.clean_dump(spark, path, *(str(tmp_path / d) for d in ("csv", "bad", "log")), WHEN, ["n", "note"], "gzip")
    assert found == {"rows": 40, "rejected": 1}
    assert list(tmp_path.glob("csv/*.gz")) and not list(tmp_path.glob("csv/*.csv"))
    assert "(7)," in "".join(gzip.open(f, "rt").read() for f in tmp_path.glob("bad/*.gz"))
    got = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "csv"))
    assert sorted((int(r.n), r.note) for r in got.collect()) == [
        (n, f"first\n\n(2,'x'),\n-- note {n}") for n in range(40)]
