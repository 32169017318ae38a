"""Projections: every operator here is one ``select`` and moves no rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgloom import config
from msgloom.config import Lineage
from msgloom.functions.text import row_id
from msgloom.functions.times import When, moment

Field = tuple[str | Column, str]


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and columns use many times.

    A plain column would be put into each place that uses it and worked out there again.
    Filters are not moved through a generator, so behind one it is worked out once per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def flatten_nested(df: DataFrame, fields: Mapping[str, Field]) -> DataFrame:
    """Flat typed columns from nested paths: ``{name: (path or expression, type)}``."""
    return df.select(
        *[
            (F.col(source) if isinstance(source, str) else source).cast(kind).alias(name)
            for name, (source, kind) in fields.items()
        ]
    )


def add_lineage(
    df: DataFrame,
    lineage: Lineage,
    as_of: When,
    id_column: str,
    id_keys: Sequence[str | Column],
    **more: Column,
) -> DataFrame:
    """Stamp row id, times and origin on every row.

    The id is a hash of the keys, so that a retried task or a repeated run writes the
    same id again; pass ``more`` for batch, path and date columns.
    """
    now = moment(as_of)
    keys = [F.col(k) if isinstance(k, str) else k for k in id_keys]
    stamps = {
        id_column: row_id(*keys),
        "r_created_at": now,
        "r_updated_at": now,
        "source": F.lit(lineage.source),
        "connector_id": F.lit(lineage.connector_id),
        "user_id": F.lit(lineage.user_id).cast("string"),
        "account_id": F.lit(lineage.account_id).cast("string"),
        "profile_workspace_id": F.lit(lineage.profile_workspace_id).cast("string"),
    }
    return df.withColumns({**stamps, **more})


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are there; absent names are passed over.

    A new name that another column already has would make it ambiguous and is refused.
    """
    used = {old: new for old, new in names.items() if old in df.columns and old != new}
    kept = set(df.columns) - set(used)
    clash = sorted(kept & set(used.values()))
    if clash:
        raise ValueError(f"rename would repeat columns: {clash}")
    # One projection renames all at once, so that two names can also be exchanged.
    return df.select(*[F.col(f"`{c}`").alias(used.get(c, c)) for c in df.columns])


def conform_to_schema(
    df: DataFrame, schema: T.StructType, also: Sequence[str] = ()
) -> DataFrame:
    """The schema's columns, in its order and types; missing ones are typed nulls.

    Columns in ``also`` are carried along in front.
    """
    have = set(df.columns)
    return df.select(
        *also,
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
    )


def columns_minus(columns: Iterable[str], keep: Iterable[str]) -> list[str]:
    """Column names outside ``keep``, in input order."""
    kept = set(keep)
    return [c for c in columns if c not in kept]


def pack_unmapped(df: DataFrame, keep: Iterable[str], into: str = "unmapped") -> DataFrame:
    """Fold every column outside ``keep`` into one JSON column, in input order."""
    keep = list(keep)
    extras = columns_minus(df.columns, [*keep, into])
    packed = (
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in extras]))
        if extras
        else F.lit(config.NO_UNMAPPED)
    )
    kept = [F.col(f"`{c}`") for c in df.columns if c in keep and c != into]
    return df.select(*kept, packed.alias(into))


def _without_void(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_without_void(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(
            _without_void(kind.keyType), _without_void(kind.valueType), kind.valueContainsNull
        )
    if isinstance(kind, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _without_void(f.dataType), f.nullable) for f in kind.fields]
        )
    return kind


def fix_void_columns(df: DataFrame) -> DataFrame:
    """Give untyped nulls a string type, at any depth, and leave all else alone."""
    fixed = {
        f.name: F.col(f"`{f.name}`").cast(_without_void(f.dataType))
        for f in df.schema.fields
        if _without_void(f.dataType) != f.dataType
    }
    return df.withColumns(fixed) if fixed else df


def drop_and_restamp(
    df: DataFrame,
    as_of: When,
    new_id: str,
    id_keys: Sequence[str],
    parent: Mapping[str, str] | None = None,
    drop: Sequence[str] = ("r_created_at", "r_updated_at", "batch_id"),
) -> DataFrame:
    """Start a new layer: old stamps go, the parent's id stays under a new name."""
    now = moment(as_of)
    out = rename_map(df.drop(*drop), parent or {})
    return out.withColumns(
        {
            new_id: row_id(F.lit(new_id), *[F.col(k) for k in id_keys]),
            "r_created_at": now,
            "r_updated_at": now,
        }
    )


def select_contract(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The business view: the named columns only."""
    return df.select(*columns)


def constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fixed values as columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def cast_columns(
    df: DataFrame, types: Mapping[str, str], defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Cast columns, text that does not fit becoming null, then fill their defaults."""
    defaults = defaults or {}
    casts = {}
    for name, kind in types.items():
        value = F.col(name).try_cast(kind)
        casts[name] = F.coalesce(value, defaults[name]) if name in defaults else value
    return df.withColumns(casts)


def flatten_struct_into(df: DataFrame, name: str) -> DataFrame:
    """Lift a struct's fields to the top; they win over columns of the same name.

    Where a field is null or absent, a column of the same name keeps its own value.
    """
    nested = df.schema[name].dataType.fieldNames()
    outer = [c for c in df.columns if c != name]
    both = set(outer) & set(nested)

    def lifted(field: str) -> Column:
        inner = F.col(name)[field]
        if field in both:
            inner = F.coalesce(inner, F.col(field))
        return inner.alias(field)

    return df.select(
        *[F.col(f"`{c}`") for c in outer if c not in both], *[lifted(f) for f in nested]
    )
