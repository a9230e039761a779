"""Identifier quoting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: Column) -> Column:
    """Backtick-quote an identifier column; inner backticks are doubled."""
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))


def quote_if_needed(name: Column) -> Column:
    """Leave plain words bare, quote anything else."""
    return F.when(name.rlike(r"^\w+$"), name).otherwise(quote(name))


def quoted_literal(name: str) -> str:
    """The same quoting for a name known when the plan is built."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(*parts: Column | str) -> Column:
    """Concatenate statement pieces; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
