"""Readers of landed metadata: listing pages, JSON records, catalog snapshots, stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeferry.functions import REJECTED
from lakeferry.operators.inventory import with_database_column
from lakeferry.schemas import INVENTORY


def json_pages(spark: SparkSession, path: str, page_per_line: bool = False) -> DataFrame:
    """Response pages in ``page``, one per file or one per line; folders like ``kind=Jobs`` become
    a partition column, so reading one kind lists and reads only its own files."""
    return spark.read.text(path, wholetext=not page_per_line).withColumnRenamed("value", "page")


def json_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON records with a declared schema, nothing inferred."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def table_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Landed extended table listing (database or namespace, tableName, isTemporary, information)."""
    return with_database_column(spark.read.parquet(path))


def stored_inventory(spark: SparkSession, path: str) -> DataFrame:
    """A written inventory; the declared schema saves reading one footer per database."""
    return spark.read.schema(INVENTORY).parquet(path).select(*INVENTORY.names)


def _checked(spark: SparkSession, path: str, schema: StructType, rejected: bool) -> DataFrame:
    stored = StructType([*(f for f in schema if f.name != REJECTED)])
    stored = stored.add(REJECTED, "string").add("is_rejected", "boolean")
    return spark.read.schema(stored).parquet(path).where(F.col("is_rejected") == rejected)


def accepted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of documents that could be read, from what ``sinks.write_checked`` wrote."""
    return _checked(spark, path, schema, False).drop(REJECTED, "is_rejected")


def rejected(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The reject table: one row for each document that could not be read, its text in ``rejected``."""
    return _checked(spark, path, schema, True).drop("is_rejected")


def grants_table(
    spark: SparkSession, table: str, principals: Sequence[str] | None = None
) -> DataFrame:
    """A stored grant extract, optionally only of some principals (pushed into the scan)."""
    grants = spark.table(table)
    return grants if principals is None else grants.where(F.col("Principal").isin(list(principals)))


def permissions_of(spark: SparkSession, table: str, labels: Sequence[str]) -> DataFrame:
    """Stored permission rows of some artifact types; prunes to their partitions."""
    return spark.table(table).where(F.col("artifact_type").isin(list(labels)))
