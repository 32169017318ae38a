"""One row per key.

All of these number the rows of a key in a full order and keep the first. Spark limits
each group to that one row before the shuffle as well as after it (the plan shows
``WindowGroupLimit`` twice), so a key that holds a third of all rows sends one row per
map task, and no task ever sees the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgloom.operators.classify import split_by

Order = Sequence[str | Column]


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    null_keys: str = "group",
    row_key: str | None = None,
) -> DataFrame:
    """The first row of every key in the given order, which must leave no ties.

    Rows with a null in the key form a group of their own (``group``, as in SQL), are
    all kept (``keep``, told apart by ``row_key``) or all left out (``drop``).
    """
    if null_keys not in ("group", "keep", "drop"):
        raise ValueError(f"null_keys: {null_keys}")
    if null_keys == "keep" and row_key is None:
        raise ValueError("keeping null keys needs a row_key")
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    by = [F.col(k) for k in keys]
    if null_keys == "drop":
        df = df.filter(~any_null)
    if null_keys == "keep":
        # Each such row is a group of its own, spread over all tasks by its row key.
        by.append(F.when(any_null, F.col(row_key)))
    first = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Order,
    null_keys: str = "group",
    row_key: str | None = None,
) -> DataFrame:
    """Repeated ids reduced to the row that comes first in the order (newest first)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return keep_first(df, keys, order, null_keys, row_key)


def first_touch(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    where: Column | None = None,
    null_keys: str = "group",
    row_key: str | None = None,
) -> DataFrame:
    """First row per key among the rows that meet ``where``; other rows stay as they are.

    Only the rows that meet the predicate are shuffled.
    """
    if where is None:
        return keep_first(df, keys, order, null_keys, row_key)
    touched, others = split_by(df, where)
    return others.unionByName(keep_first(touched, keys, order, null_keys, row_key))


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """The last row of every key: a newer one replaces the older ones."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return keep_first(df, keys, [F.desc(c) for c in order])


def anti_new_rows(new: DataFrame, existing: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows whose key the existing data lacks.

    The existing side is reduced to its keys and made distinct on them, which the join
    needs as partitioning anyway; a hot key there arrives as one row.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return new.join(existing.select(*keys).distinct(), keys, "left_anti")
