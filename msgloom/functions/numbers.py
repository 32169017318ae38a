"""Counters, rates and cost."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def counter(*cols: Column) -> Column:
    """Sum of counters where a missing one counts as zero."""
    return reduce(add, (F.coalesce(c, F.lit(0)) for c in cols))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share of the whole in percent, 0.0 where the whole is not positive."""
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))


def cost(credits: Column, price: float, as_type: str = "decimal(18,4)") -> Column:
    """Credits at a price each. Decimal sums exactly; ``float`` keeps the older shape."""
    if as_type.startswith("decimal"):
        return (credits * F.lit(str(price)).cast("decimal(18,4)")).cast(as_type)
    return (credits * F.lit(price)).cast(as_type)


def exact_sum(col: Column) -> Column:
    """Sum of money-like doubles, to eight decimals, that does not depend on task order."""
    return F.sum(col.cast("decimal(38,8)")).cast("double")


def exact_avg(col: Column) -> Column:
    """Average of money-like doubles that does not depend on task order."""
    return exact_sum(col) / F.count(col)
