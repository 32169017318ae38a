"""Look-ups by Bloom filters, and stored pages as a source with a bookmark."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom.operators import dedup, known_ids
from msgloom.sources import page_files
from msgloom.streaming import page_landing

RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.LongType()),
])


def layer_of(spark, path, first, last, batch, per_day=500):
    """Ids of a range as a layer's batch, ``per_day`` to a folder."""
    rows = spark.range(first, last).select(
        F.sha2(F.col("id").cast("string"), 256).alias("rid"),
        F.format_string("2024%04d", (F.col("id") / per_day).cast("int")).alias("day"),
        F.lit(batch).alias("batch_id"),
    )
    rows.write.mode("append").partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def ids(spark, first, last):
    return spark.range(first, last).select(F.sha2(F.col("id").cast("string"), 256).alias("rid"), "id")


# --- filters -----------------------------------------------------------------------
def test_only_folders_that_may_hold_an_id_are_opened(spark, tmp_path):
    raw, parts, work = (str(tmp_path / name) for name in ("raw", "parts", "work"))
    layer = layer_of(spark, raw, 0, 10_000, 1)
    assert known_ids.complete(layer, "rid", "day", parts) == 1
    layer = layer_of(spark, raw, 10_000, 10_700, 2)
    assert known_ids.complete(layer, "rid", "day", parts) == 2
    assert known_ids.complete(layer, "rid", "day", parts) == 2
    filters = known_ids.read_parts(spark, parts)
    new = ids(spark, 10_400, 12_000)
    got = known_ids.anti_new_rows_by_filter(new, layer, "rid", "day", filters, work)
    assert sorted(r.id for r in got.collect()) == list(range(10_700, 12_000))
    pairs = spark.read.parquet(work)
    assert {r[0] for r in pairs.select("_folder").distinct().collect()} == {"20240020", "20240021"}
    opened = {line for line in got._jdf.queryExecution().toString().splitlines() if "day" in line}
    assert any("PartitionFilters: [cast(day" in line for line in opened), opened


def test_filters_give_the_rows_of_the_plain_anti_join(spark, tmp_path):
    """Null ids and folders, repeats of known and new ids, and numbers as ids."""
    layer_rows = [(1, "a"), (2, "a"), (2, None), (3, "b"), (None, "b"), (None, None)]
    rows = spark.createDataFrame(layer_rows, "id long, day string")
    rows.write.partitionBy("day").parquet(str(tmp_path / "raw"))
    layer = spark.read.parquet(str(tmp_path / "raw"))
    known_ids.write_part(layer, "id", "day", str(tmp_path / "parts"), 1)
    new = spark.createDataFrame(
        [(1, "x"), (1, "y"), (3, "x"), (4, "x"), (4, "x"), (None, "x"), (2, "z")], "id long, v string"
    )
    filters = known_ids.read_parts(spark, str(tmp_path / "parts"))
    got = known_ids.anti_new_rows_by_filter(new, layer, "id", "day", filters, str(tmp_path / "work"))
    want = dedup.anti_new_rows(new, layer, "id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_filters_yet_and_no_new_ids(spark, tmp_path):
    layer = layer_of(spark, str(tmp_path / "raw"), 0, 10, 1)
    none = known_ids.read_parts(spark, str(tmp_path / "parts"))
    assert none.count() == 0
    known_ids.complete(layer, "rid", "day", str(tmp_path / "parts"))
    filters = known_ids.read_parts(spark, str(tmp_path / "parts"))
    new = ids(spark, 0, 0)
    got = known_ids.anti_new_rows_by_filter(new, layer, "rid", "day", filters, str(tmp_path / "work"))
    assert got.count() == 0


def test_filters_miss_nothing_and_are_seldom_wrong(spark, tmp_path):
    held = ids(spark, 0, 60_000).withColumn("day", F.lit("d"))
    part = known_ids.filter_part(held, "rid", "day")
    assert known_ids.maybe_known(held, "rid", part).count() == 60_000
    # 200,000 foreign ids: less than one wrong answer is to be expected.
    assert known_ids.maybe_known(ids(spark, 100_000, 300_000), "rid", part).count() <= 3


def test_parts_merge_by_or(spark):
    low, high = (ids(spark, a, a + 1000).withColumn("day", F.lit("d")) for a in (0, 1000))
    parts = known_ids.filter_part(low, "rid", "day").unionByName(known_ids.filter_part(high, "rid", "day"))
    one = known_ids.merged(parts)
    assert one.count() <= parts.count()
    assert known_ids.maybe_known(low.unionByName(high), "rid", one).count() == 2000


# --- pages -------------------------------------------------------------------------
def page(folder, name, records, end="\n"):
    folder.mkdir(exist_ok=True)
    text = "\n".join(json.dumps({"id": i, "ts": t}) for i, t in records)
    (folder / name).write_text(text + end)


def landed(spark, tmp_path):
    lines = page_files.stream_pages(spark, str(tmp_path / "pages"))
    found = page_files.records(lines, RECORD)
    paths = [str(tmp_path / name) for name in ("out", "filters", "work", "checkpoint")]
    page_landing.land_once(found, "id", ["page", "place"], *paths)
    rows = spark.read.parquet(str(tmp_path / "out"))
    return sorted((r.id, r.ts) for r in rows.collect())


def test_each_record_lands_once_late_ones_and_ties_included(spark, tmp_path):
    folder = tmp_path / "pages"
    page(folder, "page-001.json", [("a", 1), ("b", 2), ("c", 2)])
    page(folder, "page-002.json", [("c", 2), ("d", 3)], end="")
    # The last line of an open page may still be on its way.
    assert landed(spark, tmp_path) == [("a", 1), ("b", 2), ("c", 2)]
    page(folder, "page-002.json", [("c", 2), ("d", 3), ("e", 3)], end="")
    page(folder, "page-003.json", [("late", 0), ("e", 3), ("f", 3), ("a", 1)])
    whole = [("a", 1), ("b", 2), ("c", 2), ("d", 3), ("e", 3), ("f", 3), ("late", 0)]
    assert landed(spark, tmp_path) == whole
    assert landed(spark, tmp_path) == whole


@pytest.mark.parametrize("taken", range(7))
def test_restart_from_any_bookmark(tmp_path, taken):
    """The spans before a bookmark and after it hold each line once, wherever it lies."""
    folder = tmp_path / "pages"
    page(folder, "p1", [("a", 1), ("b", 2), ("c", 3)])
    page(folder, "p2", [("d", 4), ("e", 5), ("f", 6)], end="")
    reader = page_files.PageStreamReader(str(folder), {"page": "", "place": 0})
    path = str(folder)
    places = [(s.page, place + len(line) + 1) for s in page_files.PageReader(path).partitions()
              for line, place in page_files._lines(path, s)]
    name, place = [("", 0), *places][taken]
    mark = {"page": name, "place": place}
    end = {"page": "p3", "place": 0}
    page(folder, "p3", [])

    def read(a, b):
        return [r["line"] for s in reader.partitions(a, b) for batch in reader.read(s) for r in batch.to_pylist()]

    before = read({"page": "", "place": 0}, mark) if taken else []
    # Bookmarks lie behind whole lines; the last line of p2 has an end only once p3 is there.
    found = [json.loads(line)["id"] for line in [*before, *read(mark, end)]]
    assert found == list("abcdef")


def test_batch_reading_keeps_unreadable_lines(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "p1").write_text('{"id": "ä", "ts": 1}\n\n{"id": \n')
    (folder / "_tmp").write_text('{"id": "hidden"}\n')
    rows = page_files.records(page_files.read_pages(spark, str(folder)), RECORD).collect()
    assert [(r.id, r.ts, r.page) for r in rows] == [("ä", 1, "p1"), (None, None, "p1")]
    assert rows[1]._corrupt == '{"id": ' and rows[0]._corrupt is None
    assert rows[1].place == len('{"id": "ä", "ts": 1}\n\n'.encode())


def test_long_lines_reach_over_chunks(tmp_path, monkeypatch):
    monkeypatch.setattr(page_files, "CHUNK", 7)
    folder = tmp_path / "pages"
    page(folder, "p1", [("a" * 40, 1), ("b", 2)])
    size = (folder / "p1").stat().st_size
    assert page_files._whole_lines(str(folder), "p1", size - 3) == size - len('{"id": "b", "ts": 2}\n')
    lines = [line for line, _ in page_files._lines(str(folder), page_files.Span("p1", 0, None))]
    assert [json.loads(line)["ts"] for line in lines] == [1, 2]


def test_no_pages(spark, tmp_path):
    assert page_files.read_pages(spark, str(tmp_path / "none")).count() == 0
