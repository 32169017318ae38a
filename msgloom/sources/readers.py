"""Readers: fixed schemas, no inference, partition columns instead of folder walks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import config
from msgloom.functions.times import When, moment
from msgloom.operators.dedup import keep_first
from msgloom.operators.shape import compute_once
from msgloom.schemas import ENVELOPE_METADATA, LANDING_DAY, WEBHOOK, envelope


CORRUPT = "_corrupt_record"


def read_json_documents(
    spark: SparkSession, path: str, schema: T.StructType, modified_after: str | None = None
) -> DataFrame:
    """One (pretty-printed) JSON document per file, in any folder below the path.

    ``modified_after`` leaves out files last written before that time.
    """
    reader = spark.read.schema(schema).options(multiLine=True, recursiveFileLookup=True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.json(path)


def read_ndjson(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    by_day: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """One JSON object per line; ``by_day`` adds the folder columns year, month and day.

    Filters on those columns then choose folders before any file is opened. ``corrupt``
    adds a column with the text of lines that are no valid JSON.
    """
    if corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    if by_day:
        schema = T.StructType(schema.fields + LANDING_DAY.fields)
    return spark.read.schema(schema).json(path)


def _whole_files(spark: SparkSession, path: str, modified_after: str | None) -> DataFrame:
    """Each file below the path as one text, with its name."""
    reader = spark.read.option("recursiveFileLookup", True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), "value")


def _parsed(text: str, schema: T.StructType) -> Column:
    """Struct from JSON text, with the text itself where it is not sound."""
    checked = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, checked, {"columnNameOfCorruptRecord": CORRUPT})


def read_checked_documents(
    spark: SparkSession, path: str, schema: T.StructType, modified_after: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents with their file, and the files that are no valid JSON: file, content and reason.

    Without the check such a file would become a record of nulls. Files are read as text,
    as a JSON source does not give its corrupt records alone.
    """
    files = _whole_files(spark, path, modified_after)
    parsed = _parsed("value", schema)
    read = compute_once(files, "_parsed", parsed)
    torn = F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull()
    good = read.filter(~torn).select("_file", *[F.col("_parsed")[f].alias(f) for f in schema.fieldNames()])
    reason = F.lit("Invalid JSON").alias("reason")
    bad = read.filter(torn).select(F.col("_file").alias("file"), F.col("value").alias("content"), reason)
    return good, bad


def unwrap_envelope(documents: DataFrame) -> DataFrame:
    """One row per record in ``data``, with the envelope's own fields as ``landing_*``."""
    fields = documents.schema["metadata"].dataType.fieldNames()
    outer = [F.col("metadata")[f].alias(f"landing_{f}") for f in fields]
    return documents.select(*outer, F.inline("data"))


def read_notifications(
    spark: SparkSession, path: str, record: T.StructType, modified_after: str | None = None
) -> DataFrame:
    """Records from envelopes and from flat one-record files, mixed in any way.

    Files that cannot be read are left out; ``read_checked_notifications`` gives them too.
    """
    return read_checked_notifications(spark, path, record, modified_after)[0]


def read_checked_notifications(
    spark: SparkSession,
    path: str,
    record: T.StructType,
    modified_after: str | None = None,
    file_column: str | None = None,
    seen: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records, and the files that give none: file, content and reason.

    ``file_column`` adds the file that each record stands in. ``seen`` observes the number of
    files that give none, as ``bad``, while the records are read.

    ``data`` is an array of records in an envelope and a plain map field in a flat file. A
    sound envelope is parsed once, to its records; any other file is parsed with ``data`` as
    raw text, and that by what the file turned out to be.
    """
    files = _whole_files(spark, path, modified_after)
    loose = T.StructType(
        [T.StructField("metadata", ENVELOPE_METADATA)]
        + [T.StructField(f.name, T.StringType()) if f.name == "data" else f for f in record.fields]
    )
    whole = T.StructType(
        [T.StructField(f.name, T.ArrayType(record)) if f.name == "data" else f for f in loose.fields]
    )
    # Without the word a file is no envelope, and need not be tried as one.
    tried = F.when(F.col("value").contains('"metadata"'), _parsed("value", whole))
    documents = compute_once(files, "_listed", tried)
    inside = F.col("_listed.data")
    sound = (
        F.col("_listed.metadata").isNotNull() & F.col(f"_listed.{CORRUPT}").isNull()
        & (F.size(inside) > 0) & ~F.exists(inside, lambda one: one.isNull())
    )
    sound = F.coalesce(sound, F.lit(False))
    # Only of other files is the text still needed.
    documents = documents.select(
        "_file", F.when(sound, inside).alias("_sound"), F.when(~sound, F.col("value")).alias("value")
    )
    documents = compute_once(documents, "_loose", _parsed("value", loose))
    held = F.col("_loose")
    is_sound = F.col("_sound").isNotNull()
    torn = ~is_sound & (held.isNull() | held[CORRUPT].isNotNull())
    data_type = record["data"].dataType
    flat = F.struct(
        *[
            F.from_json(held["data"], data_type).alias("data") if n == "data" else held[n].alias(n)
            for n in record.fieldNames()
        ]
    ).cast(record)
    is_envelope = ~is_sound & held["metadata"].isNotNull()
    listed = F.when(is_envelope, F.from_json(held["data"], T.ArrayType(record)))
    # A text that is no list of records parses to null, or to a list of one null.
    is_list = F.btrim(held["data"]).startswith("[") & listed.isNotNull()
    unread = is_envelope & held["data"].isNotNull() & ~F.coalesce(is_list, F.lit(False))
    reason = F.when(torn, "Invalid JSON").when(unread, "Invalid data")
    content = F.when(torn, F.col("value")).otherwise(held["data"])
    bad = documents.filter(reason.isNotNull()).select(
        F.col("_file").alias("file"), content.alias("content"), reason.alias("reason")
    )
    if seen:
        documents = documents.observe(seen, F.count(reason).alias("bad"))
    records = F.when(is_sound, F.col("_sound")).when(is_envelope, listed).otherwise(F.array(flat))
    file = [F.col("_file").alias(file_column)] if file_column else []
    return documents.filter(reason.isNull()).select(F.inline(records), *file), bad


def envelope_mismatches(documents: DataFrame) -> DataFrame:
    """Envelopes whose stated record count is not the number of records they hold."""
    held = F.coalesce(F.size("data"), F.lit(0))
    stated = F.col("metadata.record_count")
    return documents.filter(~held.eqNullSafe(stated)).select(
        "metadata", held.alias("records_held")
    )


def read_envelopes(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Envelope documents as they are, to unwrap or check."""
    return read_json_documents(spark, path, envelope(record))


def read_layer(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet layer; its partition folders come back as columns.

    With a schema no file is opened to find one, folder names get the type they had when
    written, columns come in its order, and a layer without rows can be read too.
    """
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_layer_or_previous(
    spark: SparkSession,
    path: str,
    day: When,
    schema: T.StructType | None = None,
    column: str = "processing_date",
) -> DataFrame:
    """The rows of a run day, or of the day before if that one has none.

    Both the choice and the read touch those two partitions only.
    """
    run = F.to_date(moment(day))
    days = [F.date_format(d, "yyyyMMdd") for d in (run, F.date_sub(run, 1))]
    layer = read_layer(spark, path, schema)
    value = F.col(column).cast("string")
    newest = layer.filter(value.isin(*days)).agg(F.max(value)).first()[0]
    if newest is None:
        raise ValueError(f"no rows for the run day or the day before in {path}")
    return layer.filter(value == newest)


def read_day_range(
    df: DataFrame, start: When, end: When, columns: Sequence[str] = ("year", "month", "day")
) -> DataFrame:
    """Rows of an inclusive range of day folders; absent days simply give none.

    The test uses partition columns only, so it chooses folders and reads no others.
    """
    day = F.make_date(*[F.col(c).cast("int") for c in columns])
    return df.filter(day.between(F.to_date(moment(start)), F.to_date(moment(end))))


def half_open_day_window(df: DataFrame, ts: str, day: When) -> DataFrame:
    """Rows from the start of a day up to, not including, the start of the next."""
    start = F.to_date(moment(day))
    kind = df.schema[ts].dataType
    return df.filter(
        (F.col(ts) >= start.cast(kind)) & (F.col(ts) < F.date_add(start, 1).cast(kind))
    )


def read_since_cursor(
    df: DataFrame, ts: str, cursor: Column | str | None, start: str = config.HISTORICAL_START
) -> DataFrame:
    """Rows after a saved position, or from the historical start without one."""
    if not isinstance(cursor, Column):
        cursor = F.lit(cursor or start)
    return df.filter(F.col(ts) > cursor.cast(df.schema[ts].dataType))


def left_by_cursor(df: DataFrame, ts: str, cursor: str | None) -> DataFrame:
    """One row: how many rows ``read_since_cursor`` leaves out, at the position, before it, without a time."""
    at = F.lit(cursor).cast(df.schema[ts].dataType)
    return df.agg(
        F.count_if(F.col(ts) == at).alias("at_position"),
        F.count_if(F.col(ts) < at).alias("before_position"),
        F.count_if(F.col(ts).isNull()).alias("without_time"),
    )


def daily_snapshots(
    spark: SparkSession, path: str, schema: T.StructType, key: str = "id"
) -> DataFrame:
    """All days' full lists with their ``snapshot_day``, each id once a day (from the newest file)."""
    day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    files = ("file_modification_time", "file_name")
    found = read_ndjson(spark, path, schema, by_day=True).select(
        "*", day.alias("snapshot_day"), *[F.col(f"_metadata.{name}").alias(f"_{name}") for name in files]
    )
    order = [*[F.desc(f"_{name}") for name in files], F.xxhash64(*schema.fieldNames())]
    once = keep_first(found, ["snapshot_day", key], order)
    return once.drop("year", "month", "day", *[f"_{name}" for name in files])


def read_sql_dump(spark: SparkSession, path: str) -> DataFrame:
    """Lines of dump text, blank ones left out. Spark splits big files by line.

    ``dump_text.read_dump_records`` joins the lines of one quoted value.
    """
    return spark.read.text(path).filter(F.btrim("value", F.lit(" \t\r\n\f\v")) != "")


def read_catalog_max(spark: SparkSession, table: str, column: str) -> int | None:
    """Highest value of a column in a catalog table; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    return spark.table(table).agg(F.max(column)).first()[0]


def parse_payload(
    df: DataFrame, body: str, schema: T.StructType, error: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """Columns from a JSON body, and the rows whose body is no valid JSON object.

    A body that is a struct already is taken as it is.
    """
    if isinstance(df.schema[body].dataType, T.StructType):
        good = df.select(*[c for c in df.columns if c != body], f"{body}.*")
        return good, df.filter(F.lit(False)).withColumn(error, F.lit(None).cast("string"))
    corrupt = "_corrupt_record"
    checked = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    parsed = compute_once(
        df, "_parsed", F.from_json(body, checked, {"columnNameOfCorruptRecord": corrupt})
    )
    is_bad = F.col("_parsed").isNull() | F.col(f"_parsed.{corrupt}").isNotNull()
    outer = [F.col(f"`{c}`") for c in df.columns if c != body]
    good = parsed.filter(~is_bad).select(
        *outer, *[F.col("_parsed")[f].alias(f) for f in schema.fieldNames()]
    )
    bad = parsed.filter(is_bad).drop("_parsed").withColumn(error, F.lit("Invalid JSON"))
    return good, bad


def read_webhook_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored webhook requests, one document of headers and body per line."""
    return spark.read.schema(WEBHOOK).json(path)


def latest_snapshot(
    spark: SparkSession, path: str, schema: T.StructType, key: str = "id"
) -> DataFrame:
    """The newest day's full list from a folder of daily snapshots, each id once.

    Of several snapshots of that day the newest file that holds an id gives its row.
    """
    snapshots = read_ndjson(spark, path, schema, by_day=True)
    day = F.make_date("year", F.col("month").cast("int"), F.col("day").cast("int"))
    newest = snapshots.select(day.alias("_day")).agg(F.max("_day")).first()[0]
    files = ("file_modification_time", "file_name")
    found = snapshots.filter(day == F.lit(newest)).withColumns(
        {f"_{name}": F.col(f"_metadata.{name}") for name in files}
    )
    order = [*[F.desc(f"_{name}") for name in files], F.xxhash64(*schema.fieldNames())]
    once = keep_first(found, [key], order)
    return once.drop("year", "month", "day", *[f"_{name}" for name in files])
