"""Operators on small frames; cases that older jobs got wrong are named."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import config
from msgloom.config import Lineage
from msgloom.operators import aggregate, classify, dedup, joins, rows, shape, sqldump
from msgloom.schemas import UNIFIED


def values(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=str)


# --- shape -------------------------------------------------------------------------
def test_flatten_nested_names_with_blanks_and_marks(spark):
    kind = "a STRUCT<`To Number`: STRING, `$x`: STRUCT<`b c`: STRING>>"
    df = spark.createDataFrame([((("1", ("2",)),))], kind)
    flat = shape.flatten_nested(df, {"to": ("a.`To Number`", "int"), "b": ("a.`$x`.`b c`", "string")})
    assert values(flat) == [(1, "2")]


def test_rename_map_passes_over_absent_names_and_refuses_a_clash(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b INT")
    assert shape.rename_map(df, {"a": "c", "z": "y"}).columns == ["c", "b"]
    assert shape.rename_map(df, {"a": "b", "b": "a"}).columns == ["b", "a"]
    with pytest.raises(ValueError, match="repeat"):
        shape.rename_map(df, {"a": "b"})


def test_conform_twice_is_conform_once(spark):
    df = spark.createDataFrame([("7", "x", 1)], "connector_id STRING, source_id STRING, extra INT")
    once = shape.conform_to_schema(df, UNIFIED)
    assert once.schema.simpleString() == UNIFIED.simpleString()
    assert shape.conform_to_schema(once, UNIFIED).collect() == once.collect()
    assert len(once.columns) == 47


def test_pack_unmapped_keeps_input_order_and_every_column(spark):
    df = spark.createDataFrame([(1, 2, None, 4)], "z INT, keep INT, n INT, a INT")
    packed = shape.pack_unmapped(df, ["keep", "absent"])
    assert packed.columns == ["keep", "unmapped"]
    assert packed.first().unmapped == '{"z":1,"a":4}'
    none = shape.pack_unmapped(df.select("keep"), ["keep"]).first()
    assert none.unmapped == config.NO_UNMAPPED


def test_void_leaves_become_text_and_nothing_else_changes(spark):
    df = spark.range(1).select(
        F.lit(None).alias("v"),
        F.array(F.lit(None)).alias("arr"),
        F.struct(F.lit(1).alias("n"), F.array(F.struct(F.lit(None).alias("x"))).alias("deep")).alias(
            "s"
        ),
        F.lit(2).alias("n"),
    )
    fixed = shape.fix_void_columns(df)
    assert [f.dataType.simpleString() for f in fixed.schema] == [
        "string", "array<string>", "struct<n:int,deep:array<struct<x:string>>>", "int",
    ]
    assert shape.fix_void_columns(fixed) is fixed


def test_lineage_ids_repeat_and_restamp_keeps_the_parent(spark):
    df = spark.createDataFrame([("a",), (None,)], "id STRING")
    lineage = Lineage("src", "45", user_id="85")
    first, second = (
        shape.add_lineage(df, lineage, "2024-01-01", "record_id", ["id"]) for _ in range(2)
    )
    assert values(first, "record_id") == values(second, "record_id")
    assert first.first().account_id is None and first.first().user_id == "85"
    layer = shape.drop_and_restamp(first, "2024-01-02", "opt_id", ["id"], {"record_id": "raw_id"})
    assert values(layer, "raw_id") == values(first, "record_id")
    assert layer.first().r_created_at == dt.datetime(2024, 1, 2)


def test_cast_columns_turns_dirty_text_into_the_default(spark):
    df = spark.createDataFrame([("x", "7"), ("2024-01-01", None)], "t STRING, n STRING")
    cast = shape.cast_columns(
        df, {"t": "timestamp", "n": "int"}, {"t": F.lit("2000-01-01").cast("timestamp")}
    )
    assert values(cast) == [(dt.datetime(2000, 1, 1), 7), (dt.datetime(2024, 1, 1), None)]


def test_struct_fields_win_only_where_they_hold_something(spark):
    kind = "a STRING, s STRUCT<a: STRING, b: STRING>"
    df = spark.createDataFrame([("out", ("in", "x")), ("out", (None, "y")), ("out", None)], kind)
    flat = shape.flatten_struct_into(df, "s")
    assert flat.columns == ["a", "b"]
    assert values(flat) == sorted([("in", "x"), ("out", "y"), ("out", None)], key=str)


# --- classify ----------------------------------------------------------------------
def test_bots_go_only_where_the_flag_is_true(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "n INT, bot BOOLEAN")
    assert values(classify.drop_bots(df, "bot"), "n") == [(2,), (3,)]
    assert values(classify.drop_bots(df, "bot", where=F.col("n") > 1), "n") == [(1,), (2,), (3,)]


def test_split_loses_no_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n INT, k STRING")
    met, others = classify.split_by(df, F.col("k") == "a")
    assert values(met, "n") == [(1,)] and values(others, "n") == [(2,), (3,)]


def test_codes_with_null_take_the_default(spark):
    df = spark.createDataFrame([("XsRJQh",), ("zz",), (None,)], "c STRING")
    name = classify.map_codes(F.col("c"), config.EVENT_NAMES, "Unknown")
    found = df.select("c", name.alias("n"), classify.map_status(name).alias("s"),
                      classify.map_direction(name).alias("d"))
    assert values(found) == sorted(
        [("XsRJQh", "SMS Sent", "SMS SEND", "MO"), ("zz", "Unknown", "OTHER", "MT"),
         (None, "Unknown", "OTHER", "MT")], key=str)


@pytest.mark.parametrize(
    ("email", "sms", "expected"),
    [(True, True, "EMAIL"), (False, True, "SMS"), (None, None, "PUSH_NOTIFICATION")],
)
def test_channel(spark, email, sms, expected):
    df = spark.createDataFrame([(email, sms)], "e BOOLEAN, s BOOLEAN")
    assert df.select(classify.classify_channel(F.col("e"), F.col("s"))).first()[0] == expected


def test_delivery_status(spark):
    df = spark.createDataFrame([(True, 1), (False, 1), (None, None)], "c BOOLEAN, d INT")
    found = df.select(classify.delivery_status(F.col("c"), F.col("d")))
    assert values(found) == [("CANCELED",), ("COMPLETED",), ("IN_PROGRESS",)]


def test_links(spark):
    df = spark.createDataFrame(
        [("https://bit.ly/x", None), (None, "see http://a"), (None, "none"), (None, None)],
        "u STRING, t STRING",
    )
    found = df.select(
        classify.has_link([F.col("u")], F.col("t")), classify.link_shortened(F.col("u"))
    )
    assert [tuple(r) for r in found.collect()] == [(1, "YES"), (1, None), (0, None), (0, None)]


def test_require_fields_names_what_is_missing(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, "")], "x STRING, y STRING")
    valid, invalid = classify.require_fields(df, ["x", "y"])
    assert values(valid) == [("a", "b")]
    assert values(invalid, "reason") == [
        ("Missing required fields: x",), ("Missing required fields: x, y",),
    ]


# --- dedup -------------------------------------------------------------------------
def test_first_touch_ties_go_by_id_and_null_keys_follow_the_rule(spark):
    rows_ = [("p", "m", 5, "b"), ("p", "m", 5, "a"), (None, "m", 1, "c"), (None, "m", 2, "d")]
    df = spark.createDataFrame(rows_, "profile STRING, msg STRING, t INT, id STRING")
    keys, order = ["profile", "msg"], ["t", "id"]
    assert values(dedup.first_touch(df, keys, order), "id") == [("a",), ("c",)]
    kept = dedup.first_touch(df, keys, order, null_keys="keep", row_key="id")
    assert values(kept, "id") == [("a",), ("c",), ("d",)]
    dropped = dedup.first_touch(df, keys, order, null_keys="drop")
    assert values(dropped, "id") == [("a",)]
    with pytest.raises(ValueError, match="row_key"):
        dedup.first_touch(df, keys, order, null_keys="keep")


def test_dedup_twice_is_dedup_once(spark):
    rows_ = [(i % 7, random.Random(i).random()) for i in range(100)]
    df = spark.createDataFrame(rows_, "id INT, t DOUBLE")
    once = dedup.dedup_by_key(df, "id", [F.desc("t")])
    assert values(dedup.dedup_by_key(once, "id", [F.desc("t")])) == values(once)
    best = defaultdict(float)
    for key, t in rows_:
        best[key] = max(best[key], t)
    assert values(once) == sorted(best.items(), key=str)


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    """A third of all rows share a key: each map task sends one of them."""
    df = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("t")
    )
    first = dedup.keep_first(df, ["key"], ["t"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert first.count() == 60_001
    assert first.filter("key = -1").first().t == 0


def test_anti_new_rows_and_latest(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k INT, v STRING")
    known = spark.createDataFrame([(1,), (1,), (3,)], "k INT")
    assert values(dedup.anti_new_rows(new, known, "k"), "v") == [("b",), ("c",)]
    talk = spark.createDataFrame([("x", 1), ("x", 3), ("y", 2)], "who STRING, t INT")
    assert values(dedup.latest_per_key(talk, "who", ["t"])) == [("x", 3), ("y", 2)]


# --- aggregate ---------------------------------------------------------------------
def test_next_batch_id(spark):
    df = spark.createDataFrame([(3,), (None,)], "batch_id INT")
    assert aggregate.next_batch_id(df).first()[0] == 4
    assert aggregate.next_batch_id(df.filter("batch_id IS NULL")).first()[0] == 1
    assert aggregate.next_batch_id(df.limit(0)).first()[0] == 1
    assert aggregate.next_batch_id(spark.range(1)).first()[0] == 1


def test_observed_counts(spark):
    df, seen = aggregate.row_counts(spark.range(10), "ten", even=F.col("id") % 2 == 0)
    df.collect()
    assert aggregate.observed(seen) == {"rows": 10, "even": 5}


def test_observed_counts_of_a_frame_found_empty_on_the_way(spark):
    none = dedup.anti_new_rows(spark.range(5), spark.range(5), "id").repartition(3)
    df, seen = aggregate.row_counts(none, "none")
    df.write.format("noop").mode("overwrite").save()
    assert aggregate.observed(seen).get("rows", 0) == 0


def test_max_cursor_keeps_the_old_one(spark):
    df = spark.createDataFrame([("b",), ("a",)], "t STRING")
    assert aggregate.max_cursor(df, "t", F.lit("0")).first()[0] == "b"
    assert aggregate.max_cursor(df.limit(0), "t", F.lit("0")).first()[0] == "0"


# --- joins -------------------------------------------------------------------------
@pytest.mark.parametrize("pieces", [1, 2, 7, 64])
def test_reply_to_sent_against_brute_force(spark, pieces):
    """One conversation holds a third of the rows; some replies have no conversation."""
    pick = random.Random(7)
    def key():
        return "hot" if pick.random() < 0.34 else pick.choice(["a", "b", "c", None])
    sent = [(key(), pick.randrange(40), f"s{i}") for i in range(120)]
    replies = [(key(), pick.randrange(40), f"r{i}") for i in range(200)]
    expected = []
    for k, t, r in replies:
        before = [(st, s) for sk, st, s in sent if sk is not None and sk == k and st <= t]
        expected.append((r, max(before)[1] if before else None))
    got = joins.reply_to_sent(
        spark.createDataFrame(sent, "k STRING, t INT, s STRING"),
        spark.createDataFrame(replies, "k STRING, t INT, r STRING"),
        "k", "t", "t", {"s": "sent"}, pieces,
    )
    assert got.columns == ["k", "t", "r", "sent"]
    assert values(got, "r", "sent") == sorted(expected, key=str)


def test_reply_to_sent_by_time_and_without_rows(spark):
    sent = spark.createDataFrame([("a", dt.datetime(2025, 1, 1), "s")], "k STRING, t TIMESTAMP, s STRING")
    replies = spark.createDataFrame(
        [("a", dt.datetime(2025, 1, 2), "r"), ("a", dt.datetime(2024, 1, 1), "q")],
        "k STRING, t TIMESTAMP, r STRING",
    )
    got = joins.reply_to_sent(sent, replies, "k", "t", "t", {"s": "sent"})
    assert values(got, "r", "sent") == [("q", None), ("r", "s")]
    zoneless = F.col("t").cast("timestamp_ntz")
    sent_ntz, replies_ntz = sent.withColumn("t", zoneless), replies.withColumn("t", zoneless)
    got = joins.reply_to_sent(sent_ntz, replies_ntz, "k", "t", "t", {"s": "sent"})
    assert values(got, "r", "sent") == [("q", None), ("r", "s")]
    with pytest.raises(TypeError, match="string"):
        joins.reply_to_sent(sent, replies, "k", "s", "r", {"s": "sent"})
    none = joins.reply_to_sent(sent.limit(0), replies.limit(0), "k", "t", "t", {"s": "sent"})
    assert none.count() == 0


def test_decode_keeps_every_fact(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k INT, v STRING")
    dim = spark.createDataFrame([(1, "one")], "id INT, name STRING")
    got = joins.decode_with_dimension(facts, dim, "k", "id", {"name": "label"})
    assert values(got) == sorted([(1, "x", "one"), (2, "y", None), (None, "z", None)], key=str)


def test_decode_with_a_repeated_key_ends_with_an_error(spark):
    """Null keys match nothing, and a repeated key that no fact has does no harm."""
    dim = spark.createDataFrame([(1, "one"), (1, "uno"), (2, "two"), (None, "a"), (None, "b")], "id INT, name STRING")
    fine = spark.createDataFrame([(2, "y"), (None, "z")], "k INT, `v.w` STRING")
    got = joins.decode_with_dimension(fine, dim, "k", "id", {"name": "label"})
    assert values(got, "k", "label") == sorted([(2, "two"), (None, None)], key=str)
    facts = spark.createDataFrame([(1, "x")], "k INT, v STRING")
    with pytest.raises(Exception, match="id is not unique in the dimension: 1"):
        joins.decode_with_dimension(facts, dim, "k", "id", {"name": "label"}).collect()


# --- rows --------------------------------------------------------------------------
def test_recipient_rows_and_recombine(spark):
    df = spark.createDataFrame([("m", "1", "2")], "sid STRING, a STRING, b STRING")
    assert values(rows.per_recipient_rows(df, ["a", "b"])) == [("m", "1"), ("m", "2")]
    assert rows.recombine(df, df, df).count() == 3


def test_html_rows_with_short_rows_and_markup(spark):
    html = (
        "<TABLE><tr class='h'><th>A</th></tr>\n<tr><td> <i>x</i> </td><td>1 &amp;\n2</td></tr>"
        "<tr></tr></TABLE>"
    )
    pages = spark.createDataFrame([(1, html), (2, None), (3, "none")], "page_id INT, html STRING")
    got = rows.extract_html_rows(pages, keep=["page_id"])
    assert values(got) == [(1, 0, []), (1, 1, ["x", "1 &\n2"]), (1, 2, [])]


def test_long_row_of_markup_is_read_whole(spark):
    cells = "".join(f"<td>{'x' * 50}{i}</td>" for i in range(20_000))
    pages = spark.createDataFrame([(f"<tr>{cells}</tr>",)], "html STRING")
    got = rows.extract_html_rows(pages).first()
    assert len(got.cells) == 20_000 and got.cells[-1].endswith("x19999")


def test_first_sample_and_sorted_rows(spark):
    df = spark.createDataFrame([(3, "c"), (1, "b"), (1, "a")], "t INT, id STRING")
    assert tuple(rows.first_row(df, "t", "id").first()) == (1, "a")
    assert rows.sample_rows(df, 2).count() == 2
    assert [r.id for r in rows.time_sorted(df, "t", "id").collect()] == ["a", "b", "c"]


# --- SQL dump ----------------------------------------------------------------------
DUMP = [
    "(`ticket`,`opened`,`due`,`closed`,`state`,`note`,`account`),",
    "(701,'2021-03-02','2021-03-09','2021-03-05','Done',NULL,44),",
    "(702,'2021-03-04','2021-03-11','2021-03-08','Done','Ask for a key.',51),",
    "(703,'2021-03-07','2021-03-14',null,'Open','',63);",
]


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING").coalesce(1)


def test_dump_example(spark):
    df = lines(spark, *DUMP)
    header = sqldump.tuple_header(df)
    good, bad = sqldump.parse_tuples(df, header)
    assert header[0] == "ticket" and len(header) == 7
    assert [",".join(r) for r in good.collect()] == [
        "701,2021-03-02,2021-03-09,2021-03-05,Done,,44",
        "702,2021-03-04,2021-03-11,2021-03-08,Done,Ask for a key.,51",
        "703,2021-03-07,2021-03-14,,Open,,63",
    ]
    assert bad.count() == 0


def test_every_data_line_goes_to_rows_or_rejects(spark):
    df = lines(
        spark, "-- a comment", "INSERT INTO `t` (`a`,`b`) VALUES (1,'x'),(2,'y;(z)'),", "(3,null)", "(4,'p'), (5)",
        "insert into t values", "(6,'q');", "", "loose text", "(7,'r'", "VALUES", "(8,NOW()),",
    )
    good, bad = sqldump.parse_tuples(df, ["a", "b"])
    assert values(good) == [("1", "x"), ("2", "y;(z)"), ("3", ""), ("4", "p"), ("6", "q")]
    assert {tuple(r) for r in bad.collect()} == {
        ("(5)", "1 values for 2 columns"), ("(7,'r'", "unreadable value"),
        ("(8,NOW()),", "unreadable value"), ("loose text", "no tuple"),
    }


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("(1,'a, b',NULL),", ["1", "a, b", ""]),
        ("(-5,TRUE,1.5e3);", ["-5", "TRUE", "1.5e3"]),
        (r"('it''s','it\'s','a\\b'),", ["it's", "it's", "a\\b"]),
        ("( 1 , 'x' , '' ),", ["1", "x", ""]),
        ("('(x),','),',NULL),", ["(x),", "),", ""]),
        ("('NULL',NULL,'`'),", ["NULL", "", "`"]),
        ("('','''',''''''),", ["", "'", "''"]),
    ],
)
def test_tuple_values(spark, line, expected):
    assert lines(spark, line).select(sqldump.tuple_values(F.col("value"))).first()[0] == expected
    good, bad = sqldump.parse_tuples(lines(spark, line), ["a", "b", "c"])
    assert list(good.first()) == expected and bad.count() == 0


@pytest.mark.parametrize("line", ["(1,2),", "(1,2,3,4),", "(1,'x,3),", "(1,'a'b,3),", "(1,a'b,3);"])
def test_lines_that_do_not_fit_are_kept_apart(spark, line):
    good, bad = sqldump.parse_tuples(lines(spark, line), ["a", "b", "c"])
    assert good.count() == 0 and bad.first().line == line and bad.first().reason


def test_tuple_of_long_texts(spark):
    text = r"a''b\'," * 50_000
    good, _ = sqldump.parse_tuples(lines(spark, f"('{text}',1),"), ["t", "n"])
    assert good.first().t == "a'b'," * 50_000


def test_header_is_the_first_one_and_later_ones_are_no_data(spark):
    df = lines(spark, "INSERT INTO t VALUES", "(`a`,`b`),", "(1,2),", "(`c`,`d`),")
    assert sqldump.tuple_header(df) == ["a", "b"]
    good, bad = sqldump.parse_tuples(df, ["a", "b"])
    assert values(good) == [("1", "2")] and bad.count() == 0
    assert sqldump.tuple_header(lines(spark, "(1,2),")) is None


def test_schemas_have_their_sizes():
    from msgloom.schemas import NOTIFICATION, OPTIMIZED_CAMPAIGN, SENT_MESSAGE

    assert len(NOTIFICATION) == 114
    assert len(OPTIMIZED_CAMPAIGN) == len(set(OPTIMIZED_CAMPAIGN)) == 39
    assert len(UNIFIED) == 47 and len(SENT_MESSAGE) == 15
    assert isinstance(NOTIFICATION["platform_delivery_stats"].dataType.valueType, T.StructType)
