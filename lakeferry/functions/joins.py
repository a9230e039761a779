"""Lookup sides for joins whose other side may be skewed.

Adaptive execution splits a hot partition only where both join inputs arrive through an exchange
of the join itself. A lookup that was just grouped by the join key needs no further exchange and
would block the split, so these helpers group by one more, derived column. The extra shuffle
moves distinct keys only; a small lookup is still broadcast by its measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD = "_spread"


def lookup(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct ``keys`` of a frame."""
    return df.select(*keys, F.hash(*keys).alias(_SPREAD)).distinct().drop(_SPREAD)


def grouped_lookup(df: DataFrame, keys: list[str], *values: Column) -> DataFrame:
    """One row per ``keys`` with aggregated values."""
    return df.groupBy(*keys, F.hash(*keys).alias(_SPREAD)).agg(*values).drop(_SPREAD)


def last_answer(rows: DataFrame, keys: list[str], *values: str, time: str = "answered_at") -> DataFrame:
    """One row per ``keys`` with ``answer``, the values of the latest row by ``time``.

    Rows without the column count as equally old; of equally old rows the largest values stay. The keys
    name one row of the other side, so no partition of the join is hot: the rows are shuffled once, for
    the grouping and the join.
    """
    value = F.struct(*values)
    age = F.col(time) if time in rows.columns else F.lit(0)
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct(age, value)).alias("answer"))
