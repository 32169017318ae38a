"""Expressions over many generated values, each set in one Spark job, against plain Python."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from msgloom import config
from msgloom.functions import messages, numbers
from msgloom.functions import text as X
from msgloom.operators import dedup, sqldump

few = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
TEXT = st.text(
    alphabet=st.sampled_from(list("ab01 ,'\"\\`(){}+-;éN\t")), min_size=0, max_size=12
)
MANY = st.lists(TEXT, min_size=50, max_size=200)


def apply(spark, column, values, kind="STRING"):
    df = spark.createDataFrame(list(enumerate(values)), f"i INT, x {kind}")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


@few
@given(MANY)
def test_phone(spark, values):
    def expected(text):
        if text == "":
            return text
        digits = re.sub(r"[^0-9]", "", text)
        return None if not digits else "+1" + (digits[1:] if digits[0] == "1" else digits)

    assert apply(spark, X.us_phone(F.col("x")), values) == [expected(v) for v in values]


@few
@given(MANY)
def test_strip_template(spark, values):
    values = [v.replace("(", "{{").replace(")", "}}") for v in values]
    expected = [re.sub(r"\{\{[^}]+\}\}", "", v) for v in values]
    assert apply(spark, X.strip_template(F.col("x")), values) == expected


@few
@given(st.lists(st.lists(TEXT, min_size=3, max_size=3), min_size=30, max_size=100))
def test_tuples_come_back(spark, rows):
    """Any texts, escaped either way and put into a tuple, are read back as they were."""

    def quoted(text, i):
        safe = text.replace("\\", "\\\\")
        return "'" + safe.replace("'", "''" if i % 2 else "\\'") + "'"

    lines = [(i, f"({','.join(quoted(t, i) for t in row)}),") for i, row in enumerate(rows)]
    df = spark.createDataFrame(lines, "i INT, value STRING")
    got = df.select("i", sqldump.tuple_values(F.col("value")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == rows
    good, bad = sqldump.parse_tuples(df, ["a", "b", "c"])
    assert bad.count() == 0
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, rows))


def test_all_flag_sets(spark):
    """Every one of the 4096 sets of time slots."""
    bits = spark.range(1 << 12)
    flags = {s: F.col("id").bitwiseAND(F.lit(1 << i)) != 0 for i, s in enumerate(config.SLOTS)}
    got = bits.select(
        "id",
        messages.first_true_slot(flags).alias("slot"),
        messages.availability_sentence(flags).alias("said"),
    ).collect()
    start = "I've shared that you're available "
    for r in got:
        on = [s for i, s in enumerate(config.SLOTS) if r.id >> i & 1]
        phrases = [config.SLOT_PHRASES[s] for s in on]
        assert r.slot == (config.SLOT_TITLES[on[0]] if on else config.DEFAULT_SLOT_TITLE)
        if not on:
            assert r.said == "I've shared that your availability is flexible."
        elif len(on) == 1:
            assert r.said == f"{start}{phrases[0]}."
        else:
            assert r.said == f"{start}{', '.join(phrases[:-1])} or {phrases[-1]}."


def test_rates_of_all_small_counts(spark):
    pairs = [(n, d) for d in range(41) for n in range(d + 1)]
    df = spark.createDataFrame(pairs, "n INT, d INT")
    rates = df.select("n", "d", numbers.pct(F.col("n"), F.col("d")).alias("rate")).collect()
    cent = Decimal("0.01")
    for r in rates:
        exact = Decimal(repr(r.n / r.d * 100)).quantize(cent, ROUND_HALF_UP) if r.d else 0
        assert r.rate == float(exact), r


@few
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["hot", "hot", "a", "b", None]),
            st.integers(0, 5),
        ),
        min_size=20,
        max_size=120,
    )
)
def test_first_per_key(spark, rows):
    found = [(k, t, i) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame(found, "k STRING, t INT, i INT").repartition(4)
    best = {}
    for k, t, i in found:
        best[k] = min(best.get(k, (t, i)), (t, i))
    got = dedup.keep_first(df, ["k"], ["t", "i"])
    assert {r.k: (r.t, r.i) for r in got.collect()} == best
    touched = dedup.first_touch(df, ["k"], ["t", "i"], F.col("t") > 2)
    firsts = {}
    for k, t, i in found:
        if t > 2:
            firsts[k] = min(firsts.get(k, (t, i)), (t, i))
    expected = {i for _, t, i in found if t <= 2} | {i for _, i in firsts.values()}
    assert {r.i for r in touched.collect()} == expected
