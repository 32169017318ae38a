"""Stream joins, late rows, first touches with an end, table grids and as-of names."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from msgloom import config
from msgloom.operators import asof, grid, joins
from msgloom.plans import landing, notifications, pages
from msgloom.sinks import writers
from msgloom.sources import readers
from msgloom.streaming import late, matching, streams, touches

START = dt.datetime(2025, 11, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def stream_of(spark, path, batches, schema):
    """A stream with one micro-batch for each list of rows."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{i:03d}")
    found = spark.createDataFrame([], schema)
    return streams.read_files(
        spark, "parquet", f"{path}/*", found.schema, maxFilesPerTrigger=1, latestFirst=False
    )


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_of_replies_to_sent(spark, tmp_path, salts):
    rnd = random.Random(5)
    sent = [(f"c{rnd.randrange(4)}", at(i * 40), f"m{i}") for i in range(60)]
    replies = [(f"r{i}", rnd.choice(["c0", "c1", "c2", "c9", None]), at(rnd.randrange(2400))) for i in range(80)]
    # Rows of the far future bring the watermark past all others.
    sent_batches = [sent[i : i + 20] for i in range(0, 60, 20)] + [[("end", at(10**6), "end")]]
    ordered = sorted(replies, key=lambda r: r[2])
    reply_batches = [ordered[i : i + 27] for i in range(0, 80, 27)] + [[("end", "none", at(10**6))]]
    s = stream_of(spark, str(tmp_path / "s"), sent_batches, "conv string, sent_at timestamp, body string")
    r = stream_of(spark, str(tmp_path / "r"), reply_batches, "id string, conv string, came timestamp")
    found = matching.stream_reply_to_sent(
        s, r, "conv", "sent_at", "came", {"body": "answered"}, "10 minutes", "1 hour", salts
    )
    streams.write_stream(found, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = {x.id: x.answered for x in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {}
    for i, conv, came in replies:
        near = [(t, m) for c, t, m in sent if c == conv and came - dt.timedelta(minutes=10) <= t <= came]
        want[i] = max(near)[1] if near else None
    got.pop("end", None)
    assert got == want and None in want.values() and len(set(want.values())) > 10
    near = [(c, t, m) for c, t, m in sent]
    batch = joins.reply_to_sent(
        spark.createDataFrame(near, "conv string, sent_at timestamp, body string"),
        spark.createDataFrame(replies, "id string, conv string, came timestamp"),
        "conv", "sent_at", "came", {"body": "answered", "sent_at": "then"},
    )
    close = F.col("then") >= F.col("came") - F.expr("INTERVAL 10 minutes")
    assert {x.id: x.a for x in batch.select("id", F.when(close, F.col("answered")).alias("a")).collect()} == want


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    schema = "id string, t timestamp, n int"
    batches = [
        [("a", at(0), 1), ("a", at(5), 2), ("b", at(100), 3), (None, at(90), 4)],
        [("a", at(60), 5), ("c", at(4000), 6), ("d", None, 7), (None, at(95), 8)],
        [("e", at(100), 9), ("f", at(3990), 10), ("c", at(4010), 11), ("b", at(4001), 12)],
    ]
    records = stream_of(spark, str(tmp_path / "in"), batches, schema)
    kept, behind, marks = (str(tmp_path / n) for n in ("kept", "late", "marks"))
    for _ in range(2):
        late.stream_dedup_keeping_late(records, "id", "t", "10 minutes", kept, behind, marks, str(tmp_path / "c"))
    assert sorted(r.n for r in spark.read.parquet(kept).collect()) == [1, 3, 4, 6, 10, 12]
    assert sorted(r.n for r in spark.read.parquet(behind).collect()) == [7, 9]
    rows = spark.read.parquet(marks).orderBy("ingest_batch").collect()
    assert [(r.rows, r.kept, r.late, r.repeats) for r in rows] == [(4, 3, 0, 1), (4, 1, 1, 2), (4, 2, 1, 1)]


def test_first_touches_whose_state_ends(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        schema = "who string, t timestamp, id string"
        batches = [
            [("x", at(50), "b"), ("x", at(70), "c"), ("y", at(10), "d"), ("z", at(20), None)],
            [("x", at(20), "a"), ("y", at(90), "e"), (None, at(30), "n")],
            [("w", at(5000), "g")],
            [("w", at(5001), "h"), ("x", at(5002), "i")],
            [("v", at(9000), "j")],
        ]
        records = stream_of(spark, str(tmp_path / "in"), batches, schema)
        out = str(tmp_path / "out")
        query = touches.stream_first_touch_within(
            records, ["who"], ["t", "id"], "t", "100 seconds", 600, out, str(tmp_path / "checkpoint")
        )
        current = touches.current_first_touch(spark, out, ["who"], ["t", "id"])
        want = {("x", "a"), ("y", "d"), ("z", None), (None, "n"), ("w", "g"), ("v", "j")}
        assert {(r.who, r.id) for r in current.collect()} == want
        state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        assert state[-1] < max(state)
        touches.compact_first_touch(spark, out, ["who"], ["t", "id"])
        assert {(r.who, r.id) for r in spark.read.parquet(out).collect()} == want
        assert spark.read.parquet(out).count() == len(want)
    finally:
        spark.conf.set(provider, old)


PAGES = [
    ("<table><tr><td>1<td>2<td>3</table>", [["1", "2", "3"]]),
    ("<table><!-- <tr><td>no</td></tr> --><tr><td>a<!-- x --></td><td>b</td></tr></table>", [["a", "b"]]),
    ("<table><tr><td colspan=2>a<td>b<tr><td>c<td>d<td>e</table>", [["a", "a", "b"], ["c", "d", "e"]]),
    ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr><tr><td>d</td></tr></table>",
     [["a", "b"], ["a", "c"], ["d"]]),
    ("<table><tr><td rowspan='0'>a<td>b<tr><td>c<tbody><tr><td>d</table><table><tr><td>e", [["a", "b"], ["a", "c"], ["d"], ["e"]]),
    ("<table><tr><th>h</th></tr><tr><td>x<table><tr><td>in</table>y</td><td title='a>b'>z</td></tr></table>",
     [[], ["xiny", "z"]]),
    ("<script>'<tr><td>no'</script><td>loose &amp; bare", [["loose & bare"]]),
    (None, []), ("", []), ("<p>none</p>", []),
]


def test_cells_by_place(spark):
    df = spark.createDataFrame([(i, h, "k") for i, (h, _) in enumerate(PAGES)], "page_id long, html string, cells string")
    got = {}
    for r in grid.grid_rows(df, keep=["page_id"]).collect():
        got.setdefault(r.page_id, {})[r.row_number] = r.cells
    for i, (html, want) in enumerate(PAGES):
        assert [got.get(i, {})[n] for n in sorted(got.get(i, {}))] == want, html
    assert grid.grid_rows(df.limit(0)).count() == 0


def test_roster_rows_without_end_tags(spark):
    cells = "".join(f"<td>c{i}" for i in range(9))
    html = f'<table><tr class="a singleLineDisplay">{cells}<!--<tr class="singleLineDisplay">{cells}--><tr>{cells}</table>'
    found = pages.roster_rows(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
    assert [(r["Last Name"], r.Email) for r in found] == [("c2", "c8")]


def test_a_long_page_is_read_in_one_pass():
    html = "<table>" + "<tr><td>a<td>b" * 50_000 + "<!--" * 2000 + "<script>" * 2000
    assert len(grid.page_rows(html)) == 50_000


def test_names_as_of_the_day(spark):
    rnd, day = random.Random(1), START.date()
    days = [day + dt.timedelta(d) for d in sorted(rnd.sample(range(200), 50))]
    names = {(k, d): f"{k}{rnd.choice('xyz')}" for d in days for k in "abcdef" if rnd.random() < 0.85}
    rows = [(k, d, n) for (k, d), n in names.items()] + [(None, day, "n"), ("a", None, "n")]
    intervals = asof.validity_intervals(spark.createDataFrame(rows, "id string, day date, name string"), "id", "day", ["name"])
    facts = [(i, rnd.choice([*"abcdefg", None]), at(rnd.randrange(-30, 260) * 86400 + 7)) for i in range(800)]
    facts.append((9999, "a", None))
    df = spark.createDataFrame(facts, "n int, code string, t timestamp")
    for bucket in (1, 32):
        got = {r.n: r.label for r in asof.decode_as_of(df, intervals, "code", "t", {"name": "label"}, bucket).collect()}
        assert len(got) == len(facts)
        for n, code, t in facts:
            past = [d for d in days if t is not None and d <= t.date()]
            assert got[n] == (names.get((code, past[-1])) if past else None)


def test_landing_from_the_start_position(spark, tmp_path):
    """A position written in another way than the table's times is the same moment."""
    first = dt.datetime.fromisoformat(config.HISTORICAL_START.replace("Z", "+00:00")).replace(tzinfo=None)
    rows = [(i, first + dt.timedelta(hours=i, minutes=3)) for i in range(4)] + [(8, first), (9, None)]
    records = spark.createDataFrame(rows, "id int, ts timestamp")
    paths = str(tmp_path / "landed"), str(tmp_path / "log")
    got = [landing.run(spark, records, "ts", *paths, dt.datetime(2025, 12, d, 6), start=config.HISTORICAL_START) for d in (1, 2)]
    assert [g["records"] for g in got] == [4, 0]
    assert got[0]["end_cursor"] == got[1]["end_cursor"]
    assert spark.read.json(paths[0]).count() == 4
    metrics = spark.read.parquet(paths[1]).orderBy("run_timestamp").first().metrics
    assert (metrics["at_position"], metrics["before_position"], metrics["without_time"]) == (1, 0, 1)
    assert readers.left_by_cursor(records, "ts", None).first().at_position == 0


def test_a_merge_that_failed_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    """Rows of other campaigns survive a failure between the folders that are replaced."""
    spark.sql("DROP TABLE IF EXISTS merge_test")
    path = f"file://{tmp_path}/table"
    schema = "source_id string, campaign_id string, n int, connector_id int, event_date string"
    keys = ["connector_id", "event_date"]
    old = [("a", "a", 1, 1, "d1"), ("b", "b", 1, 1, "d1"), ("c", "c", 1, 1, "d2"), ("e", "e", 1, 1, "d3")]
    writers.append_table(spark.createDataFrame(old, schema), "merge_test", keys, path)
    new = spark.createDataFrame([("a", "a", 2, 1, "d2"), ("e", "e", 2, 1, "d2")], schema)
    want = [("a", 2, "d2"), ("b", 1, "d1"), ("c", 1, "d2"), ("e", 2, "d2")]

    def rows():
        spark.catalog.refreshTable("merge_test")
        return sorted(map(tuple, spark.table("merge_test").select("campaign_id", "n", "event_date").collect()))

    def fail(*args):
        writers.remove_folder(spark, f"{path}/connector_id=1/event_date=d1")
        raise RuntimeError("lost in between")

    with monkeypatch.context() as patch:
        patch.setattr(notifications.writers, "replace_partitions", fail)
        with pytest.raises(RuntimeError):
            notifications.merge_current(spark, "merge_test", new, keys)
    assert notifications.finish_merges(spark, "merge_test", keys) == 1
    assert rows() == want
    notifications.merge_current(spark, "merge_test", new, keys)
    assert rows() == want and notifications.finish_merges(spark, "merge_test", keys) == 0
    spark.sql("DROP TABLE merge_test")
