"""Fields outside the fixed schemas are kept, listed, and reach the unified contract."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom.config import EventSettings
from msgloom.plans import events
from msgloom.sources import readers
from msgloom.sources.unknown import drift, read_ndjson_keeping_unknown
from tests.test_jobs import LINEAGE, SENT, WHEN, event, land, layers_at

INNER = T.StructType([T.StructField("known", T.IntegerType())])
SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("inner", INNER)])


def _lines(folder: Path, *lines: str) -> str:
    folder.mkdir(parents=True)
    (folder / "x.json").write_text("\n".join(lines))
    return str(folder)


def test_unknown_fields_of_the_record_and_of_inner_objects(spark, tmp_path):
    path = _lines(
        tmp_path / "in",
        '{"id":"a","new":{"deep":[1,null]},"inner":{"known":1,"other":"x"}}',
        '{"id":"b","inner":{"known":2}}',
        '{"id":"c","inner":null,"new":null}',
        "",
        "no json",
        '{"id":"d","inner":[1]}',
    )
    read = read_ndjson_keeping_unknown(spark, path, SCHEMA, ["inner"])
    rows = {r["id"]: r for r in read.withColumn("u", F.to_json("unknown_fields")).collect()}
    assert len(rows) == 5
    assert json.loads(rows["a"]["u"]) == {"new": {"deep": [1, None]}, "inner.other": "x"}
    assert rows["a"]["inner"]["known"] == 1
    assert rows["b"]["u"] is None and rows["b"]["inner"]["known"] == 2
    assert json.loads(rows["c"]["u"]) == {"new": None}
    assert rows[None]["_corrupt_record"] == "no json" and rows[None]["u"] is None


def test_drift_lists_each_field_with_one_type(spark, tmp_path):
    path = _lines(
        tmp_path / "in", '{"id":"a","n":1,"m":1}', '{"id":"b","n":2.5,"m":"x"}', '{"id":"c"}', '{"id":"d","n":null}'
    )
    found = drift(read_ndjson_keeping_unknown(spark, path, SCHEMA)).collect()
    rows = {r["field"]: (r["rows"], r["type"]) for r in found}
    assert rows["m"] == (2, "VARIANT")
    assert rows["n"][0] == 3 and rows["n"][1].startswith("DECIMAL")
    assert set(rows) == {"m", "n"}
    empty = read_ndjson_keeping_unknown(spark, _lines(tmp_path / "none", ""), SCHEMA)
    assert drift(empty).collect() == []


def test_a_day_filter_chooses_folders(spark, tmp_path):
    for day in ("01", "02"):
        _lines(tmp_path / f"in/year=2025/month=11/day={day}", json.dumps({"id": day, "x": 1}))
    read = read_ndjson_keeping_unknown(spark, str(tmp_path / "in"), SCHEMA, by_day=True)
    kept = readers.read_day_range(read, dt.date(2025, 11, 2), dt.date(2025, 11, 3))
    assert [(r["id"], r["year"], r["day"]) for r in kept.collect()] == [("02", 2025, "02")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_a_landed_field_outside_the_schema_reaches_unmapped(spark, tmp_path):
    known, more = event("a", SENT, 1), event("b", SENT, 1)
    more["vendor"] = {"score": 0.5}
    more["attributes"]["event_properties"]["Ticket"] = 7
    land(tmp_path, 1, known, more)
    layers = layers_at(tmp_path)
    day = dt.date(2025, 11, 1)
    for _ in range(2):
        events.run(spark, layers, day, day, LINEAGE, WHEN, EventSettings(keep_unknown=True))
    rows = readers.read_layer(spark, layers.unified).select("source_id", "unmapped").collect()
    packed = {r["source_id"]: json.loads(r["unmapped"]) for r in rows}
    assert len(rows) == 2
    assert packed["b"]["unknown_fields"] == {"vendor": {"score": 0.5}, "attributes.event_properties.Ticket": 7}
    assert "unknown_fields" not in packed["a"]
