"""Table inventory of a whole metastore from landed listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.functions import information_value
from lakeferry.schemas import INVENTORY

# Property names in the listing text and the marker of an empty database.
INFORMATION_KEYS = ("Type", "Provider", "Location", "Serde Library")
EMPTY_DATABASE = "Empty Database"

# Row labels of a table description.
DETAIL_MARKER = "# Detailed Table Information"
DETAIL_KEYS = {
    "storage_location": "Location",
    "storage_format": "Provider",
    "table_type": "Type",
    "managed": "Is_managed_location",
}


def with_database_column(df: DataFrame) -> DataFrame:
    """Listings name the database ``database``, ``namespace`` or ``databaseName``."""
    for name in ("namespace", "databaseName"):
        if name in df.columns and "database" not in df.columns:
            return df.withColumnRenamed(name, "database")
    return df


def parse_information(
    df: DataFrame, keys: Sequence[str] = INFORMATION_KEYS, trim: bool = True
) -> DataFrame:
    """Listing text to one column per key plus an empty ``Error``, everything as string."""
    df = with_database_column(df)
    kept = [F.col(c).cast("string").alias(c) for c in df.columns if c != "information"]
    values = [information_value(F.col("information"), k, trim).alias(k) for k in keys]
    return df.select(*kept, *values, F.lit("").alias("Error"))


def without_match(databases: DataFrame, members: DataFrame) -> DataFrame:
    """Databases that own no row of ``members``; members shrink to their names before the join."""
    return (
        databases.select("database")
        .distinct()
        .join(members.select("database").distinct(), "database", "left_anti")
    )


def metastore_inventory(databases: DataFrame, tables: DataFrame) -> DataFrame:
    """Inventory of every database in one plan; an empty database leaves one marker row."""
    databases, tables = with_database_column(databases), with_database_column(tables)
    parsed = parse_information(tables).select(*INVENTORY.names)
    empty = without_match(databases, tables).select(
        "database",
        *[F.lit("").alias(c) for c in INVENTORY.names[1:-1]],
        F.lit(EMPTY_DATABASE).alias("Error"),
    )
    return parsed.unionByName(empty)


def table_details(describe_rows: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row per table from its description rows (database, tableName, ordinal, col_name,
    data_type), reading only rows below the detail marker; the first row of a label wins. A table
    whose description has no marker is read from its first row; one without labels has nulls.

    ``errors`` (database, tableName, error) adds the tables that could not be described.
    The list kept per table holds its property rows only, so it is bounded by the table's width.
    """
    rows = with_database_column(describe_rows)
    labels = list(DETAIL_KEYS.values())
    found = (
        rows.groupBy("database", "tableName")
        .agg(
            F.min(F.when(F.col("col_name") == DETAIL_MARKER, F.col("ordinal"))).alias("marker"),
            F.collect_list(
                F.when(F.col("col_name").isin(labels), F.struct("ordinal", "col_name", "data_type"))
            ).alias("rows"),
        )
    )
    below = F.filter("rows", lambda r: F.col("marker").isNull() | (r["ordinal"] > F.col("marker")))

    def first(label: str):
        matches = F.filter(below, lambda r: r["col_name"] == label)
        return F.array_min(matches)["data_type"]

    details = found.select(
        "database",
        "tableName",
        first(DETAIL_KEYS["storage_location"]).alias("storage_location"),
        first(DETAIL_KEYS["storage_format"]).alias("storage_format"),
        first(DETAIL_KEYS["table_type"]).alias("table_type"),
        F.coalesce(first(DETAIL_KEYS["managed"]), F.lit("False")).alias("managed"),
    )
    if errors is None:
        return details.withColumn("error", F.lit(None).cast("string"))
    errors = with_database_column(errors)
    keys = ["database", "tableName"]
    return (
        details.join(errors.groupBy(*keys).agg(F.min("error").alias("error")), keys, "full_outer")
        .withColumn("managed", F.coalesce("managed", F.lit("False")))
        .select(*keys, *DETAIL_KEYS, "error")
    )


def copy_required(inventory: DataFrame) -> DataFrame:
    """Add ``should_copy``: the table is managed or sits on workspace root storage."""
    location = F.col("Location")
    root = (location.startswith("dbfs:/") | location.startswith("wasb")) & ~location.startswith(
        "dbfs:/mnt/"
    )
    managed = F.col("Type") == "MANAGED"
    return inventory.withColumn(
        "should_copy", F.coalesce(root, F.lit(False)) | F.coalesce(managed, F.lit(False))
    )


def listings(snapshot: DataFrame, kind: str) -> DataFrame:
    """The database, table or view listing of a landed catalog snapshot."""
    snapshot = with_database_column(snapshot)
    if kind == "database":
        return snapshot.select("database").distinct()
    if kind == "table":
        return snapshot.select("database", "tableName", "isTemporary")
    if kind == "view":
        is_view = information_value(F.col("information"), "Type") == "VIEW"
        return snapshot.where(is_view).select(
            "database", F.col("tableName").alias("viewName"), "isTemporary"
        )
    raise ValueError(f"unknown listing kind: {kind}")
