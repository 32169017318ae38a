"""Queries on the order tables, dump text, pages and files written and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import config
from msgloom.functions import numbers
from msgloom.functions import text as X
from msgloom.operators import aggregate, asof, classify, dedup, joins, known_ids, rows, shape, sqldump
from msgloom.plans import dumps, landing, pages
from msgloom.plans.notifications import existing_layer
from msgloom.queries.registry import query
from msgloom.queries.tables import DUMP_COLUMNS, dump_lines, table, text, utc, with_k
from msgloom.schemas import METRIC
from msgloom.session import shared_dir
from msgloom.sinks import writers
from msgloom.sources import readers
from msgloom.sources.unknown import drift, read_ndjson_keeping_unknown

WHEN = dt.datetime(2024, 2, 1)


# --- orders, parts and dimensions --------------------------------------------------
@query("""
WITH counted AS (
  SELECT l_suppkey, count(*) AS sends, count(*) FILTER (l_returnflag IN ('R', 'A')) AS delivered,
    count(*) FILTER (l_returnflag = 'R') AS clicks FROM lineitem GROUP BY l_suppkey)
SELECT *,
  floor((delivered * 20000 + sends) / (2 * sends)) / 100 AS success_rate,
  CASE WHEN delivered > 0 THEN floor((clicks * 20000 + delivered) / (2 * delivered)) / 100
       ELSE 0.0 END AS click_through_rate
FROM counted
""")
def campaign_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and rates per supplier."""
    flag = F.col("l_returnflag")
    counted = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("sends"),
        F.count_if(flag.isin("R", "A")).alias("delivered"),
        F.count_if(flag == "R").alias("clicks"),
    )
    return counted.withColumns(
        {
            "success_rate": numbers.pct(F.col("delivered"), F.col("sends")),
            "click_through_rate": numbers.pct(F.col("clicks"), F.col("delivered")),
        }
    )


@query("""
SELECT 'table' AS part, max(o_orderkey) + 1 AS batch_id FROM orders
UNION ALL SELECT 'empty', 1 UNION ALL SELECT 'nulls', 1 UNION ALL SELECT 'no column', 1
""")
def next_batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    parts = {
        "table": aggregate.next_batch_id(orders, "o_orderkey"),
        "empty": aggregate.next_batch_id(orders.filter("o_orderkey < 0"), "o_orderkey"),
        "nulls": aggregate.next_batch_id(
            orders.select(F.nullif("o_orderkey", "o_orderkey").alias("o_orderkey")), "o_orderkey"
        ),
        "no column": aggregate.next_batch_id(orders, "batch_id"),
    }
    return rows.recombine(
        *[part.select(F.lit(name).alias("part"), "batch_id") for name, part in parts.items()]
    )


@query("""
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedup.latest_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"])


@query("""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 4 = 0 THEN 'NONE' WHEN o_orderkey % 4 = 1 THEN ''
       ELSE o_orderstatus || ',' || o_orderpriority END AS segments,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS en,
  coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END, o_orderstatus) AS first_value,
  CAST(coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END, 0) + o_custkey AS BIGINT)
    AS counted
FROM orders
""")
def segments_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List, map and missing-value expressions."""
    n = F.col("o_orderkey")
    both = F.array("o_orderstatus", "o_orderpriority")
    items = F.when(n % 4 == 1, F.slice(both, 1, 0)).when(n % 4 != 0, both)
    names = F.when(n % 3 != 0, F.create_map(F.lit("en"), F.col("o_orderpriority")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        X.join_or_default(items, "NONE").alias("segments"),
        X.lang_text(names).alias("en"),
        X.first_non_null(X.lang_text(names), F.col("o_orderstatus")).alias("first_value"),
        numbers.counter(F.when(n % 3 != 0, n), F.col("o_custkey")).alias("counted"),
    )


@query("""
SELECT o_orderkey,
  CASE WHEN o_orderstatus IN ('F') THEN o_orderpriority ELSE o_orderstatus END AS chosen,
  CASE WHEN o_orderkey % 3 = 0 THEN 'EMAIL' WHEN o_orderkey % 5 = 0 THEN 'SMS'
       ELSE 'PUSH_NOTIFICATION' END AS channel,
  CASE WHEN o_orderkey % 3 = 0 THEN 'CANCELED' WHEN o_orderkey % 4 <> 0 THEN 'COMPLETED'
       ELSE 'IN_PROGRESS' END AS delivery
FROM orders
""")
def order_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choice by code, channel by flags (one of them never set) and delivery status."""
    n = F.col("o_orderkey")
    flag = F.when(n % 3 == 0, True)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        classify.choose_by_code(
            F.col("o_orderstatus"), ["F"], F.col("o_orderpriority"), F.col("o_orderstatus")
        ).alias("chosen"),
        classify.classify_channel(flag, n % 5 == 0).alias("channel"),
        classify.delivery_status(flag, F.when(n % 4 != 0, F.col("o_orderdate"))).alias("delivery"),
    )


@query("""
SELECT 'F' AS part, count(*) AS orders FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'other', count(*) FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'
""")
def split_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, others = classify.split_by(
        table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F"
    )
    return rows.recombine(
        *[
            part.agg(F.lit(name).alias("part"), F.count("*").alias("orders"))
            for name, part in (("F", done), ("other", others))
        ]
    )


@query("""
SELECT p_partkey, p_name FROM part
WHERE p_retailprice BETWEEN 905 AND 950 AND p_size BETWEEN 5 AND 40 AND p_type = 'PROMO'
  AND p_name LIKE 's%'
""")
def listing_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify.listing_search(
        table(spark, sf_dir, "part"),
        between={"p_retailprice": (905, 950), "p_size": (5, 40)},
        equal={"p_type": "PROMO"},
        prefix={"p_name": "s"},
    )
    return found.select("p_partkey", "p_name")


@query("""
SELECT s_suppkey, n_name AS nation, r_name AS region FROM supplier
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
""")
def decode_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = joins.decode_with_dimension(
        table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"), "n_regionkey",
        "r_regionkey", {"r_name": "region"},
    )
    decoded = joins.decode_with_dimension(
        table(spark, sf_dir, "supplier"), nation, "s_nationkey", "n_nationkey",
        {"n_name": "nation", "region": "region"},
    )
    return decoded.select("s_suppkey", "nation", "region")


@query("""
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                  AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
""")
def anti_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order that is done."""
    done = "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"
    known = table(spark, sf_dir, "orders").filter(done).withColumnRenamed("o_custkey", "c_custkey")
    new = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return dedup.anti_new_rows(new, known, "c_custkey")


@query("""
SELECT event_id, event_type, ts FROM events
WHERE event_type <> 'click' OR ts >= TIMESTAMP '2024-01-16'
""")
def anti_new_rows_by_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that a layer of early clicks lacks; two batches, the filters of the second made up."""
    layer, parts, work = (shared_dir(spark, name) for name in ("layer", "layer-ids", "maybe"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    clicks = events.filter("event_type = 'click'").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    for batch, days in ((1, "ts < '2024-01-09'"), (2, "ts >= '2024-01-09' AND ts < '2024-01-16'")):
        rows_of_batch = clicks.filter(days).select("event_id", "day", F.lit(batch).alias("batch_id"))
        writers.append_layer(rows_of_batch, layer, "day")
        known_ids.complete(readers.read_layer(spark, layer, rows_of_batch.schema), "event_id", "day", parts)
    held = readers.read_layer(spark, layer, rows_of_batch.schema)
    filters = known_ids.read_parts(spark, parts)
    return known_ids.anti_new_rows_by_filter(events, held, "event_id", "day", filters, work)


# --- text --------------------------------------------------------------------------
@query("""
SELECT doc_id, replace(text, '{{', '{') AS clean, length(replace(text, '{{', '{')) AS letters
FROM (SELECT doc_id, regexp_replace(text, '\\{\\{[^}]+\\}\\}', '', 'g') AS text FROM documents)
""")
def template_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks put into every document's text, and taken out of it again."""
    marked = F.concat(F.lit("{{first name}}"), F.replace("text", F.lit(". "), F.lit(". {{x}}")))
    clean = X.strip_template(marked)
    return table(spark, sf_dir, "documents").select(
        "doc_id", clean.alias("clean"), F.length(clean).cast("bigint").alias("letters")
    )


@query("""
SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN 1 WHEN html LIKE '%http%' THEN 1 ELSE 0 END
    AS has_link,
  CASE WHEN regexp_matches(url, '(bit\\.ly|tinyurl|short|go\\.|/aff_ad)') THEN 'YES'
       ELSE 'NO' END AS shortened,
  CAST(NULL AS VARCHAR) AS no_url
FROM pages
""")
def link_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("page_id") % 3 != 0, F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        classify.has_link([url], F.col("html")).alias("has_link"),
        classify.link_shortened(F.col("url")).alias("shortened"),
        classify.link_shortened(F.lit(None).cast("string")).alias("no_url"),
    )


_LINK_ROW = r"(?s)<li>(.*?)</li>"
_LINK_CELL = r"(?s)>([^<]*)<"


@query(r"""
SELECT page_id, CAST(i - 1 AS INT) AS row_number,
  regexp_extract(item, '(?s)>([^<]*)<', 1) AS label, 'N/A' AS second
FROM (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS items FROM pages))
""")
def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list items of every page, with a default for a cell that is not there."""
    found = rows.extract_html_rows(
        table(spark, sf_dir, "pages"), row_pattern=_LINK_ROW, cell_pattern=_LINK_CELL,
        keep=["page_id"],
    )
    cells = F.col("cells")
    return found.select(
        "page_id", "row_number", X.cell(cells, 0).alias("label"), X.cell(cells, 1).alias("second")
    )


_HEADING = "".join(f"<th>H{i}</th>" for i in range(12))
_OTHER_ROW = "".join(f"<td>other {i}</td>" for i in range(12))


def _table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as result pages of 50 rows; a row has 3 to 12 cells, some with markup.

    Pages have a heading row, rows of another class and a table within a cell.
    """
    customer = table(spark, sf_dir, "customer")
    n = F.col("c_custkey")
    cells = F.transform(
        F.sequence(F.lit(0).cast("bigint"), n % 10 + 2),
        lambda i: F.concat(
            F.lit('<td class="c"> <b>'), n.cast("string"), F.lit("</b>&amp;"), i.cast("string"),
            F.when(i == 2, F.lit("<table><tr class='DisplayRegRow'><td></td></tr></table>"))
            .otherwise(""),
            F.lit(" </td>"),
        ),
    )
    row = F.concat(
        F.lit('<tr class="x DisplayRegRow singleLineDisplay">\n'), F.array_join(cells, ""), F.lit("</tr>")
    )
    numbered = customer.select(F.expr("c_custkey div 50").alias("page_id"),
                               n.alias("n"), row.alias("row"))
    held = F.array_sort(F.collect_list(F.struct("n", "row")))
    return numbered.groupBy("page_id").agg(
        F.concat(
            F.lit(f"<table><tr class='DisplayRegRow'>{_HEADING}</tr><tr>{_OTHER_ROW}</tr>"),
            F.array_join(F.transform(held, lambda r: r["row"]), ""),
            F.lit("</table>"),
        ).alias("html")
    )


@query("""
SELECT CAST(c_custkey // 50 AS BIGINT) AS page_id, CAST(c_custkey % 50 AS INT) AS row_number,
  c_custkey || '&2' AS "Last Name", c_custkey || '&3' AS "First Name",
  c_custkey || '&7' AS "Contact Phone", c_custkey || '&8' AS "Email"
FROM customer WHERE c_custkey % 10 + 3 >= 9
""")
def roster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.roster_rows(_table_pages(spark, sf_dir))


_CELL = "CASE WHEN c_custkey % 10 + 3 > {0} THEN c_custkey || '&{0}' ELSE 'N/A' END"


@query(f"""
SELECT CAST(c_custkey // 50 AS BIGINT) AS page_id, CAST(c_custkey % 50 + 1 AS INT) AS row_number,
  c_custkey || '&3' AS "MLS ID", {_CELL.format(6)} AS "Address", {_CELL.format(8)} AS "City",
  {_CELL.format(10)} AS "Price"
FROM customer WHERE c_custkey % 10 + 3 > 3
""")
def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.listing_rows(_table_pages(spark, sf_dir))


@query("""
SELECT c_custkey || '&2' AS "Last Name", c_custkey || '&3' AS "First Name",
  c_custkey || '&7' AS "Contact Phone", c_custkey || '&8' AS "Email"
FROM customer WHERE c_custkey % 10 + 3 >= 9
""")
def roster_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster rows written as CSV with a header and read back."""
    path = shared_dir(spark, "roster")
    pages.write_rows(pages.roster_rows(_table_pages(spark, sf_dir)), path)
    return spark.read.option("header", True).csv(path)


# --- SQL dump text -----------------------------------------------------------------
_NOTES = {
    0: "",
    1: "Check, then ship",
    2: "It''s here",
    3: "It''s \"new\"",
    4: "",
}
_NOTE_SQL = (
    "CASE o_orderkey % 5 "
    + " ".join(f"WHEN {i} THEN '{note}'" for i, note in _NOTES.items())
    + " END"
)


@query(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS ticket, strftime(o_orderdate, '%Y-%m-%d') AS opened,
  o_orderstatus AS state, {_NOTE_SQL} AS note, CAST(-o_custkey AS VARCHAR) AS account
FROM orders
""")
def sql_tuple_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump rows back to the columns they were made of."""
    good, _ = sqldump.parse_tuples(dump_lines(spark, sf_dir), DUMP_COLUMNS)
    return good


@query("""
SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'unreadable value' ELSE '4 values for 5 columns'
  END AS reason, count(*) AS lines
FROM orders WHERE o_orderkey % 7 < 2 GROUP BY 1
""")
def sql_tuple_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a broken text or a value too few are kept apart, with the reason."""
    key = F.regexp_extract("value", r"(\d+)", 1).cast("bigint")
    torn = F.replace("value", F.lit("-"), F.lit("'-"))
    short = F.regexp_replace("value", r",-?\d+\)", ")")
    lines = dump_lines(spark, sf_dir).select(
        F.when(key % 7 == 0, torn)
        .when(key % 7 == 1, short)
        .otherwise(F.col("value"))
        .alias("value")
    )
    _, bad = sqldump.parse_tuples(lines, DUMP_COLUMNS)
    return aggregate.count_by(bad, "reason", "lines")


@query(f"""
SELECT o_orderkey || ',' || strftime(o_orderdate, '%Y-%m-%d') || ',' || o_orderstatus || ','
  || CASE WHEN o_orderkey % 5 = 1 THEN '"Check, then ship"'
          WHEN o_orderkey % 5 = 3 THEN '"It''s ""new""' || '"' ELSE {_NOTE_SQL} END
  || ',' || (-o_custkey) AS line, 'csv' AS output
FROM orders
UNION ALL SELECT 'not a tuple,no tuple', 'bad'
""")
def dump_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump file to CSV with the header the file itself names; the text of the files."""
    base = shared_dir(spark, "dump")
    head = spark.range(1).select(
        F.lit("(" + ",".join(f"`{c}`" for c in DUMP_COLUMNS) + "),").alias("value")
    )
    torn = spark.range(1).select(F.lit("not a tuple").alias("value"))
    writers.write_lines(rows.recombine(head, dump_lines(spark, sf_dir), torn), f"{base}/in")
    dumps.clean_dump(spark, f"{base}/in", f"{base}/csv", f"{base}/bad", f"{base}/log", WHEN)
    headers = [",".join(DUMP_COLUMNS), "line,reason"]
    found = [
        spark.read.text(f"{base}/{name}").select(F.col("value").alias("line"), F.lit(name).alias("output"))
        for name in ("csv", "bad")
    ]
    return rows.recombine(*found).filter(~F.col("line").isin(headers))


@query(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS ticket, strftime(o_orderdate, '%Y-%m-%d') AS opened,
  o_orderstatus AS state, CASE WHEN o_orderkey % 3 = 0 THEN 'first' || chr(10) || chr(10) || '(2,''x''),' || chr(10)
    || '-- ' || repeat('long ', o_orderkey % 700) || chr(10) ELSE {_NOTE_SQL} END AS note,
  CAST(-o_custkey AS VARCHAR) AS account
FROM orders
""")
def dump_values_over_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of several lines, blank ones and what looks like a row among them, read back from CSV."""
    base, key = shared_dir(spark, "dump-lines"), F.regexp_extract("value", r"(\d+)", 1).cast("int")
    long = F.concat(F.lit("first\n\n(2,''x''),\n-- "), F.repeat(F.lit("long "), key % 700), F.lit("\n"))
    note = F.concat(F.regexp_extract("value", "^([^']*'[^']*','[^']*',)", 1), F.lit("'"), long, F.lit("',"),
                    F.regexp_extract("value", r"(-?\d+\)[,;])$", 1))
    lines = dump_lines(spark, sf_dir).select(F.when(key % 3 == 0, note).otherwise(F.col("value")).alias("value"))
    writers.write_lines(lines, f"{base}/in", compression="gzip", max_records=100_000)
    dumps.clean_dump(spark, f"{base}/in", f"{base}/csv", f"{base}/bad", f"{base}/log", WHEN, DUMP_COLUMNS, "gzip")
    found = spark.read.options(header=True, multiLine=True, escape='"').csv(f"{base}/csv")
    return found.fillna("")


_MIXED = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey || ',' || o_orderstatus || ',it''s'
            ELSE o_orderkey || ',' || o_orderstatus || ',NULL' END AS value,
  o_orderkey % 3 <> 0 AS cleaned
FROM orders
"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    csv = F.concat_ws(",", n.cast("string"), F.col("o_orderstatus"), F.lit("it's"))
    row = F.format_string("('%s','%s',NULL)%s", n, F.col("o_orderstatus"),
                          F.when(n % 2 == 0, ",").otherwise(";"))
    return table(spark, sf_dir, "orders").select(
        F.when(n % 3 == 0, csv).otherwise(row).alias("value")
    )


@query(_MIXED)
def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.mixed_lines(_mixed(spark, sf_dir))


@query(f"SELECT value FROM ({_MIXED})")
def mixed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "mixed")
    writers.write_lines(_mixed(spark, sf_dir), f"{base}/in")
    dumps.clean_mixed(spark, f"{base}/in", f"{base}/out", f"{base}/log", WHEN)
    return spark.read.text(f"{base}/out")


@query("""
SELECT CAST(count(*) AS BIGINT) AS lines_processed,
  count(*) FILTER (o_orderkey % 3 <> 0) AS lines_cleaned FROM orders
""")
def lines_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.lines_summary(dumps.mixed_lines(_mixed(spark, sf_dir)), F.col("cleaned"))


# --- files, layers and tables ------------------------------------------------------
@query("SELECT event_id, event_type, value FROM events")
def ndjson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as capped JSON lines, read with a fixed schema."""
    path = shared_dir(spark, "ndjson")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    writers.write_ndjson(events, path, 10_000)
    return readers.read_ndjson(spark, path, events.schema)


def _with_more_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines of which the schema knows ``event_id`` and ``place.zone`` only."""
    path = shared_dir(spark, "fields")
    n = F.col("event_id")
    place = F.struct(F.lit("z").alias("zone"), F.when(n % 5 == 0, n % 7).alias("floor"))
    score = F.when(n % 3 == 0, n % 10)
    records = table(spark, sf_dir, "events").select(
        n, F.col("event_type").alias("kind"), place.alias("place"), score.alias("score")
    )
    writers.write_ndjson(records, path, 50_000)
    schema = T.StructType.fromDDL("event_id BIGINT, place STRUCT<zone: STRING>")
    return read_ndjson_keeping_unknown(spark, path, schema, ["place"])


@query("""
SELECT event_id, 'z' AS zone, '{"kind":"' || event_type || '"' ||
  CASE WHEN event_id % 5 = 0 THEN ',"place.floor":' || event_id % 7 ELSE '' END ||
  CASE WHEN event_id % 3 = 0 THEN ',"score":' || event_id % 10 ELSE '' END || '}' AS unknown_fields
FROM events
""")
def unknown_fields_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields outside the schema, of the record and of a nested object, beside the typed ones."""
    read = _with_more_fields(spark, sf_dir)
    return read.select("event_id", "place.zone", F.to_json("unknown_fields").alias("unknown_fields"))


@query("""
SELECT 'kind' AS field, count(*) AS rows, 'STRING' AS type FROM events
UNION ALL SELECT 'place.floor', count(*), 'BIGINT' FROM events WHERE event_id % 5 = 0
UNION ALL SELECT 'score', count(*), 'BIGINT' FROM events WHERE event_id % 3 = 0
""")
def unknown_field_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift(_with_more_fields(spark, sf_dir))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 1")
def layer_or_previous_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer with the day before the run day, but not the run day, and an older one."""
    path = shared_dir(spark, "layer")
    day = F.when(F.col("o_orderkey") % 2 == 1, "20240131").otherwise("20240129")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("processing_date"))
    writers.append_layer(orders, path)
    return readers.read_layer_or_previous(spark, path, "2024-02-01").select("o_orderkey")


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS version
FROM orders
""")
def partitions_overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write replaces one partition and leaves the others."""
    path = shared_dir(spark, "partitions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    writers.overwrite_partitions(orders.withColumn("version", F.lit(1)), path, ["o_orderstatus"])
    again = orders.filter("o_orderstatus = 'F'").withColumn("version", F.lit(2))
    writers.overwrite_partitions(again, path, ["o_orderstatus"])
    return readers.read_layer(spark, path)


@query("""
SELECT c_custkey, c_nationkey FROM customer
UNION ALL SELECT c_custkey, c_nationkey FROM customer
""")
def unified_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "appended")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    writers.append_unified(customer, path)
    writers.append_unified(customer, path)
    return readers.read_layer(spark, path)


@query("""
SELECT count(*) * 2 AS rows_held, max(c_custkey) AS highest, CAST(NULL AS BIGINT) AS absent
FROM customer
""")
def table_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table made on the first write and added to by the second."""
    path = shared_dir(spark, "table")
    name = "msgloom_" + path.rsplit("-", 1)[1]
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    writers.append_table(customer, name, ["c_nationkey"], path)
    writers.append_table(customer.select("c_nationkey", "c_custkey"), name, ["c_nationkey"], path)
    highest = readers.read_catalog_max(spark, name, "c_custkey")
    absent = readers.read_catalog_max(spark, f"{name}_absent", "c_custkey")
    return spark.table(name).agg(
        F.count("*").alias("rows_held"),
        F.lit(highest).cast("bigint").alias("highest"),
        F.lit(absent).cast("bigint").alias("absent"),
    )


@query("""
SELECT 'keys' AS output, c_custkey FROM customer
UNION ALL SELECT 'rich', c_custkey FROM customer WHERE c_acctbal > 5000
""")
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One input to two outputs; a third one has no rows and is not written."""
    base = shared_dir(spark, "fan")
    written = {}

    def sink(name: str):
        def write(df: DataFrame) -> None:
            written[name] = writers.guard_empty(
                df, lambda some: writers.append_unified(some, f"{base}/{name}")
            )

        return write

    writers.fan_out(
        table(spark, sf_dir, "customer"),
        [
            (lambda df: df.select("c_custkey"), sink("keys")),
            (lambda df: df.filter("c_acctbal > 5000").select("c_custkey"), sink("rich")),
            (lambda df: df.filter("c_custkey < 0").select("c_custkey"), sink("none")),
        ],
    )
    return rows.recombine(
        *[
            readers.read_layer(spark, f"{base}/{name}").select(
                F.lit(name).alias("output"), "c_custkey"
            )
            for name, done in written.items()
            if done
        ]
    )


@query("""
SELECT event_id, CAST(year(ts) AS INT) AS year, strftime(ts, '%m') AS month,
  strftime(ts, '%d') AS day
FROM events
""")
def filed_by_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "by-time")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    writers.write_partitioned_by_time(events, "ts", path)
    return readers.read_ndjson(spark, path, T.StructType.fromDDL("event_id BIGINT"), by_day=True)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name || '-2' AS name FROM supplier")
def metric_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of a full list on two days, two of them on the newer day; the last one counts."""
    path = shared_dir(spark, "metrics")
    supplier = table(spark, sf_dir, "supplier")
    for day, mark in (("1", "1"), ("2", "x"), ("2", "2")):
        named = F.concat(F.col("s_name"), F.lit(f"-{mark}")).alias("name")
        snapshot = supplier.select(
            F.lit("metric").alias("type"),
            F.col("s_suppkey").cast("string").alias("id"),
            F.struct(named).alias("attributes"),
            F.lit(2024).alias("year"),
            F.lit("01").alias("month"),
            F.lit(f"0{day}").alias("day"),
        )
        snapshot.write.mode("append").partitionBy("year", "month", "day").json(path)
    latest = readers.latest_snapshot(spark, path, METRIC)
    return latest.select("id", F.col("attributes.name").alias("name"))


@query("""
SELECT event_id, CASE
  WHEN CAST(ts AS DATE) < DATE '2024-01-01' THEN NULL
  WHEN CAST(ts AS DATE) < DATE '2024-01-10' THEN s_name || '-1'
  WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN s_name || '-3'
  WHEN s_suppkey % 5 = 0 THEN NULL
  WHEN s_suppkey % 2 = 0 THEN s_name || '-1' ELSE s_name || '-2' END AS name
FROM events LEFT JOIN supplier ON s_suppkey = event_id % 50 + 1
""")
def decode_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the names that three daily lists give them: some renamed, some left out for a while."""
    path, n = shared_dir(spark, "metrics-by-day"), F.col("s_suppkey")
    supplier = table(spark, sf_dir, "supplier")
    marks = {"01": F.lit("1"), "10": F.when(n % 5 != 0, F.when(n % 2 == 0, "1").otherwise("2")), "20": F.lit("3")}
    for day, mark in marks.items():
        supplier.filter(mark.isNotNull()).select(
            F.lit("metric").alias("type"),
            n.cast("string").alias("id"),
            F.struct(F.concat("s_name", F.lit("-"), mark).alias("name")).alias("attributes"),
            F.lit(2024).alias("year"), F.lit("01").alias("month"), F.lit(day).alias("day"),
        ).write.mode("append").partitionBy("year", "month", "day").json(path)
    lists = readers.daily_snapshots(spark, path, METRIC).select("id", "snapshot_day", "attributes.name")
    intervals = asof.validity_intervals(lists, "id", "snapshot_day", ["name"])
    code = (F.col("event_id") % 50 + 1).cast("string").alias("code")
    events = table(spark, sf_dir, "events").select("event_id", utc(F.col("ts")).alias("ts"), code)
    return asof.decode_as_of(events, intervals, "code", "ts", {"name": "name"}).select("event_id", "name")


@query("""
WITH cut AS (SELECT max(ts) AS ts FROM events WHERE ts < TIMESTAMP '2024-01-16'),
late AS (SELECT event_id, ts >= TIMESTAMP '2024-01-16' OR event_id % 3 = 0 AND ts = (SELECT ts FROM cut)
  AS later FROM events)
SELECT event_id, 1 + CAST(coalesce(later, FALSE) AS INT) AS run FROM late
UNION ALL SELECT NULL, 3
""")
def landing_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, each from the position the last one saved; the third finds nothing new.

    Some rows of the very position where the first run ended come with the second one. Each
    event is shown with the run that landed it, the empty third run as a row of its own.
    """
    base = shared_dir(spark, "landing-job")
    events = table(spark, sf_dir, "events").withColumn("ts", utc(F.col("ts")))
    before = events.filter("ts < TIMESTAMP '2024-01-16'")
    end = before.agg(F.max("ts")).first()[0]
    first = before.filter((F.col("event_id") % 3 != 0) | (F.col("ts") != F.lit(end)))
    for i, records in enumerate((first, events, events)):
        landing.run(
            spark, records, "ts", f"{base}/data", f"{base}/log", WHEN + dt.timedelta(hours=i),
            max_records=10_000, key="event_id",
        )
    kind = T.StructType.fromDDL("event_id BIGINT, run STRING")
    landed = readers.read_ndjson(spark, f"{base}/data", kind)
    number = F.dense_rank().over(Window.orderBy("run"))  # over the runs, not their rows
    numbered = landed.select("run").distinct().withColumn("number", number)
    log = existing_layer(spark, f"{base}/log")
    empty = log.filter("total_records = 0").select(
        F.lit(None).cast("bigint").alias("event_id"), (F.hour("run_timestamp") + 1).alias("run")
    )
    found = landed.join(numbered, "run").select("event_id", F.col("number").alias("run"))
    return rows.recombine(found, empty)


@query("""
SELECT event_id, json_extract_string(props, '$.k')::INT AS number, 0 AS bad,
  'affiliate' AS utm_medium
FROM events
""")
def renamed_and_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renames that are there, casts of dirty text and constants."""
    events = with_k(table(spark, sf_dir, "events"))
    k = F.col("k")
    dirty = events.select("event_id", text("x", k).alias("bad"), k.cast("string").alias("n"))
    named = shape.rename_map(dirty, {"n": "number", "absent": "other"})
    cast = shape.cast_columns(
        shape.constants(named, config.EVENT_CAMPAIGN_TAGS),
        {"number": "int", "bad": "int"},
        {"bad": F.lit(0)},
    )
    return cast.select("event_id", "number", "bad", "utm_medium")
