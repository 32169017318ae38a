"""Fields that a fixed schema does not know: kept as VARIANT beside the typed record, and listed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom.operators.shape import compute_once
from msgloom.schemas import LANDING_DAY
from msgloom.sources.readers import CORRUPT

UNKNOWN = "unknown_fields"


def _fields_at(schema: T.StructType, path: str) -> list[str]:
    kind = reduce(lambda s, name: s[name].dataType, path.split(".") if path else [], schema)
    return kind.fieldNames()


def _unknown_at(record: Column, schema: T.StructType, path: str) -> Column:
    """The fields of the object at a path that the schema lacks; no entries without an object."""
    at = "".join(f"['{name}']" for name in path.split(".")) if path else ""
    fields = F.try_variant_get(record, f"${at}", "map<string,variant>")
    known = F.array(*[F.lit(name) for name in _fields_at(schema, path)])
    other = F.map_filter(fields, lambda name, _: ~F.array_contains(known, name))
    if path:
        other = F.transform_keys(other, lambda name, _: F.concat(F.lit(f"{path}."), name))
    return F.coalesce(other, F.create_map().cast("map<string,variant>"))


def read_ndjson_keeping_unknown(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    within: Sequence[str] = (),
    by_day: bool = False,
    into: str = UNKNOWN,
) -> DataFrame:
    """JSON lines by a fixed schema, and what it does not know as one VARIANT object.

    Looked at are the record itself and the objects at the paths ``within``, whose fields are
    named with their path. The column is null where there are none, for blank lines no row is
    made, and lines that are no JSON are records of nulls with their text in ``_corrupt_record``.
    A field that two paths would give the same name is an error. ``by_day`` adds the folder
    columns, and filters on these choose folders, as in ``read_ndjson``.
    """
    line = T.StructType([T.StructField("_line", T.StringType())] + (LANDING_DAY.fields if by_day else []))
    lines = spark.read.schema(line).text(path).filter(F.btrim("_line") != "")
    checked = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    record = compute_once(lines, "_record", F.try_parse_json("_line"))
    other = F.map_concat(*[_unknown_at(F.col("_record"), schema, p) for p in ("", *within)])
    other = compute_once(record, "_other", other)
    # The typed record comes last: Spark loses inner fields that it takes out below a generator.
    found = compute_once(other, "_typed", F.from_json("_line", checked, {"columnNameOfCorruptRecord": CORRUPT}))
    return found.select(
        *[F.col("_typed")[f].alias(f) for f in schema.fieldNames()],
        F.col(f"_typed.{CORRUPT}").alias(CORRUPT),
        *(LANDING_DAY.fieldNames() if by_day else []),
        F.when(F.size("_other") > 0, F.to_variant_object("_other")).alias(into),
    )


def drift(df: DataFrame, by: Sequence[str] = (), column: str = UNKNOWN) -> DataFrame:
    """The unknown fields with the rows that hold them and the type that fits all their values.

    Types are merged map-side, so a field that every record holds sends one row per task.
    """
    fields = F.explode(F.try_variant_get(column, "$", "map<string,variant>")).alias("field", "_value")
    return (
        df.select(*by, fields)
        .groupBy(*by, "field")
        .agg(F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg("_value").alias("type"))
    )
