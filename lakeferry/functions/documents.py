"""Reading JSON documents of a declared type: strictly, or with the broken ones set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Column that holds the text of a document that could not be read; null for the others.
REJECTED = "rejected"
_MARK = "_corrupt_document"


def with_parsed(df: DataFrame, doc: str, schema: str, rejects: bool, alias: str = "_parsed") -> DataFrame:
    """Replace the text column ``doc`` by ``alias``, the document as ``schema`` says.

    A document that is not JSON, or of another type, fails the query; with ``rejects`` it gives a null
    and its text in ``rejected`` instead, from the same parse. Then text behind the document breaks
    it too. A null text, or the document ``null``, is a null in both cases and no reject.
    """
    others = [c for c in df.columns if c not in (doc, alias, *([REJECTED] if rejects else []))]
    if not rejects:
        return df.select(*others, F.from_json(F.col(doc), schema, {"mode": "FAILFAST"}).alias(alias))
    # The corrupt column needs an object around the document, whatever its own type is.
    inside = F.concat(F.lit('{"value":'), F.col(doc), F.lit("}"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MARK}
    read = F.from_json(inside, f"struct<value:{schema},{_MARK}:string>", options)
    broken = F.col("_read")[_MARK].isNotNull()
    return df.select(*others, doc, read.alias("_read")).select(
        *others,
        F.when(~broken, F.col("_read")["value"]).alias(alias),
        F.when(broken, F.col(doc)).alias(REJECTED),
    )
