"""Quality rules whose thresholds come from quantile sketches per language and source.

A sketch counts values by bucket. A bucket keeps the seven leading bits of a whole number,
so small values are exact and large ones are off by less than 1/64. Two sketches merge by
adding their counts, in any order with one result; their size is bounded whatever the
number of rows. A rule's threshold is a fence around the middle half of the values of a
document's own language and source; where those are too few, of its language, else of all.
No fence lies further out than the bounds of the language and of the whole corpus, which come
from the half of their values on the clean side of the median: junk that makes up less than
half of them does not move them, however much of one source it is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, few_rows, stored, text_or_empty

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
          "n_marks")
MEASURED_SQL = ("doc_id bigint, lang string, source string, text_key bigint, "
                + ", ".join(f"{c} bigint" for c in COUNTS))


@dataclass(frozen=True)
class Rule:
    """A rate in thousandths and the least room its fence leaves beyond the quartile.

    A fence lies ``reach`` times the distance between the quartiles beyond them, and at
    least ``room``. ``low`` puts one below as well; such a value depends on the language, so
    that its fences are bounded by those of the language only. A bound lies a further ``room``
    beyond the median and as much as a fence beyond the quartile.
    """

    name: str
    part: str
    whole: str
    room: int
    low: bool = False


RULES = (
    Rule("symbols", "n_symbols", "n_words", 200),
    Rule("dup_lines", "n_dup_lines", "n_lines", 400),
    Rule("repeats", "n_repeat_words", "n_words", 350),
    Rule("upper", "n_upper", "word_chars", 200),
    Rule("marks", "n_marks", "n_words", 200),
    Rule("word_length", "word_chars", "n_words", 1500, low=True),
)
REACH = 3
FEWEST = 50  # documents that a group needs for thresholds of its own
MIN_WORDS = 50


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that the text holds twice or more."""
    grams = list(zip(words, words[1:], words[2:]))
    found = Counter(grams)
    if len(found) == len(grams):
        return 0
    again = np.fromiter((found[g] > 1 for g in grams), bool, len(grams))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(grams)] |= again
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """The counts of one whole text, in the order of COUNTS."""
    data = text.encode()
    words = data.split()
    if not words:
        return (0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0, 0, 0)
    lines = [line for line in data.split(b"\n") if line.strip()]
    raw = np.frombuffer(data, np.uint8)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines),
            int(((raw >= 65) & (raw <= 90)).sum()), text.count("!"))


def _measured(batches: Batches) -> Iterator[pa.RecordBatch]:
    for batch in few_rows(batches):
        rows = [measure(t) for t in batch.column(4).to_pylist()]
        counts = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(COUNTS))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *counts],
                                         names=["doc_id", "lang", "source", "text_key", *COUNTS])


def bucket(value: Column) -> Column:
    """The least value of a whole number's bucket."""
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(value)) - 7, F.lit(0)))
    return value - value % step


def rate(rule: Rule) -> Column:
    return F.floor(F.col(rule.part) * 1000 / F.greatest(F.col(rule.whole), F.lit(1))).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, rule, bucket and its rows: one sketch per language, source and rule."""
    rates = F.array(*(F.struct(F.lit(r.name).alias("rule"), bucket(rate(r)).alias("bucket")) for r in RULES))
    return (
        measured.select("lang", "source", F.inline(rates))
        .groupBy("lang", "source", "rule", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    )


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of coarser groups."""
    return sketch.groupBy(*by, "rule", "bucket").agg(F.sum("rows").alias("rows"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """For each group: its rows, and low and high fence and bound of each rule in columns."""
    group = Window.partitionBy(*by, "rule")
    upto = F.sum("rows").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    counted = sketch.withColumn("upto", upto).withColumn("all", F.sum("rows").over(group))
    at = lambda share: F.min(F.when(F.col("upto") * 4 >= F.col("all") * share, F.col("bucket")))
    quartiles = counted.groupBy(*by, "rule").agg(
        at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3"), F.first("all").alias("all")
    )
    room = F.create_map(*(F.lit(x) for r in RULES for x in (r.name, r.room)))[F.col("rule")]
    reach = F.greatest((F.col("q3") - F.col("q1")) * REACH, room)
    # The bounds: from the median, by the spread on its other side, and with a margin of ``room``.
    below = F.greatest((F.col("q2") - F.col("q1")) * REACH, room) + room
    above = F.greatest((F.col("q3") - F.col("q2")) * REACH, room) + room
    both = quartiles.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach,
                                  "least": F.col("q2") - above, "most": F.col("q2") + below})
    return both.groupBy(*by).agg(
        F.max("all").alias("rows"),
        *(F.max(F.when(F.col("rule") == r.name, F.col(end))).alias(f"{r.name}_{end}")
          for r in RULES for end in ("high", "most", *(("low", "least") if r.low else ()))),
    )


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the counts, base_failed and kept; one row for each row of ``docs``.

    ``extra`` adds the row's lang, source or text_key, the xxhash64 of its text.
    A null text has no words and fails. Null languages and sources are groups like others;
    null and repeated ids are judged row by row; further columns are not read. An empty
    table gives no row.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), F.xxhash64(text).alias("text_key"), text.alias("text"),
    )
    measured = stored(rows.mapInArrow(_measured, MEASURED_SQL), "quality")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    measured = measured.withColumn("base_failed", failed)
    sketch = sketches(measured.filter("not base_failed"))
    own = fences(sketch, "lang", "source")
    language = fences(merged(sketch, "lang"), "lang")
    whole = fences(merged(sketch))
    # The finest group with enough documents gives the fences, the coarser ones the bounds.
    enough = lambda t: F.col(f"{t}.rows") >= FEWEST
    finest = lambda n: F.when(enough("a"), F.col(f"a.{n}")).when(enough("b"), F.col(f"b.{n}")).otherwise(F.col(f"c.{n}"))
    tongue = lambda n: F.when(enough("b"), F.col(f"b.{n}"))
    ends = [F.least(finest(f"{r.name}_high"), tongue(f"{r.name}_most"),
                    F.lit(None).cast("long") if r.low else F.col(f"c.{r.name}_most")).alias(f"{r.name}_high")
            for r in RULES]
    ends += [F.greatest(finest(f"{r.name}_low"), tongue(f"{r.name}_least")).alias(f"{r.name}_low")
             for r in RULES if r.low]
    chosen = (
        own.alias("a").join(language.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang")))
        .crossJoin(F.broadcast(whole).alias("c"))  # one row
        .select("a.lang", "a.source", *ends)
    )
    same = F.col("m.lang").eqNullSafe(F.col("t.lang")) & F.col("m.source").eqNullSafe(F.col("t.source"))
    joined = measured.alias("m").join(chosen.alias("t"), same, "left")
    inside = F.lit(True)
    for r in RULES:
        inside &= bucket(rate(r)) <= F.col(f"{r.name}_high")
        if r.low:
            inside &= bucket(rate(r)) >= F.col(f"{r.name}_low")
    return joined.select(
        "doc_id", *(F.col(f"m.{c}") for c in extra), *COUNTS[:5], "base_failed",
        F.coalesce(~F.col("base_failed") & inside, F.lit(False)).alias("kept"),
    )
