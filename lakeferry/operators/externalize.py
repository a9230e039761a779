"""Managed tables to external tables: a plan, and the copy of one table."""

from __future__ import annotations

import re
import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField

from lakeferry.functions import lookup
from lakeferry.operators.inventory import DETAIL_MARKER, with_database_column
from lakeferry.session import remove

EXTERNALIZED = "TABLE IS EXTERNAL"


def externalize_plan(
    inventory: DataFrame, databases: DataFrame, root: str | None = None
) -> DataFrame:
    """Managed tables of the chosen databases with old type, new type and location.

    Without ``root`` a table keeps its location, with it each table gets ``root/database/table``.
    """
    location = (
        F.col("Location")
        if root is None
        else F.concat(F.lit(root.rstrip("/") + "/"), "database", F.lit("/"), "tableName")
    )
    chosen = lookup(with_database_column(databases), "database")
    return (
        with_database_column(inventory)
        .where(F.col("Type") == "MANAGED")
        .join(chosen, "database", "left_semi")
        .select(
            "database",
            "tableName",
            F.col("Type").alias("old_type"),
            F.lit("EXTERNAL").alias("new_type"),
            location.alias("location"),
        )
    )


def _description(spark: SparkSession, table: str) -> dict[str, str]:
    """Label → value of the table's detail rows."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    at = next(i for i, r in enumerate(rows) if r["col_name"] == DETAIL_MARKER)
    return {r["col_name"]: r["data_type"] for r in rows[at + 1 :]}


def external_definition(spark: SparkSession, table: str, name: str, path: str) -> str:
    """CREATE statement of an external table on ``path`` that is otherwise like ``table``: provider,
    columns with their types (char and varchar included) and comments, partition columns, buckets,
    options, table comment and properties."""
    text = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    head, _, body = text.partition("(")
    if not head.upper().startswith("CREATE TABLE"):
        raise ValueError(f"{table} is not a managed data source table: {head.strip()}")
    clause, found = re.subn(r"(?m)^USING (\S+)$", lambda m: f"{m[0]}\nLOCATION {quoted_text(path)}", body, count=1)
    if not found:
        raise ValueError(f"no provider in the definition of {table}")
    return f"CREATE TABLE {name} ({clause}"


def _suffixed(table: str, suffix: str) -> str:
    """A table name, quoted or not, with its last part made longer."""
    return f"{table[:-1]}{suffix}`" if table.endswith("`") else f"{table}{suffix}"


def quoted_text(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _comparable(field: StructField) -> Column:
    """A column that equal values hash alike by; maps, in which order says nothing, by sorted entries."""
    column = F.col(quoted_name(field.name))
    if isinstance(field.dataType, MapType):
        entries = F.transform_values(column, lambda _, v: F.to_json(F.struct(v.alias("v"))))
        return F.array_sort(F.map_entries(entries))
    if "map<" in field.dataType.simpleString() or "variant" in field.dataType.simpleString():
        return F.to_json(F.struct(column))
    return column


def quoted_name(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def content_checksum(rows: DataFrame) -> tuple[int, Decimal | None, Decimal | None]:
    """Number of rows and the sums of two hashes of each row, whatever their order.

    Repeated rows count as often as they occur. Two sums of independent 64-bit hashes differ for tables
    that differ, but for a chance that needs no thought.
    """
    columns = [_comparable(f) for f in rows.schema]
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)"))
        for seed in (1, 2)
    ]
    return tuple(rows.agg(F.count("*"), *sums).first())


def externalize_databases(spark: SparkSession, plan: DataFrame) -> DataFrame:
    """Make each table of an ``externalize_plan`` external at its location; one outcome row a table.

    (database, tableName, location, rows, status_code, description): a table that fails has the reason,
    and the others go on. The plan is walked row by row on the driver, as its rows are commands; the
    copies and their checks are Spark jobs.
    """
    outcomes = []
    order = plan.select("database", "tableName", "location").distinct().orderBy("database", "tableName", "location")
    for row in order.toLocalIterator():
        table = f"{quoted_name(row['database'])}.{quoted_name(row['tableName'])}"
        try:
            externalize(spark, table, row["location"])
            outcomes.append((*row, spark.table(table).count(), "SUCCESS", EXTERNALIZED))
        except Exception as error:  # noqa: BLE001
            outcomes.append((*row, None, "Error", str(error).splitlines()[0]))
    return spark.createDataFrame(
        outcomes,
        "database string, tableName string, location string, rows long, status_code string, description string",
    )


def externalize(
    spark: SparkSession, table: str, path: str, target: str | None = None
) -> str:
    """Copy a managed table onto ``path`` and register the copy as an external table with the same
    definition.

    The copy fails if ``path`` exists. Without ``target`` the copy takes over the table's name by two
    renames after the contents agree; at no time is there no table with the data, and the managed
    table is dropped last. A copy that differs, or cannot be made, is taken away again.
    """
    if _description(spark, table).get("Type") != "MANAGED":
        raise ValueError(f"{table} is not a managed table")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise ValueError(f"{path} exists already")
    tag = uuid.uuid4().hex[:12]
    name = target or _suffixed(table, f"_copy_{tag}")
    spark.sql(external_definition(spark, table, name, path))
    try:
        rows = spark.table(table)
        rows.select(*spark.table(name).columns).write.mode("append").insertInto(name)
        if content_checksum(spark.table(name).select(*rows.columns)) != content_checksum(rows):
            raise RuntimeError(f"{name} and {table} differ in content; {table} is unchanged")
    except Exception:
        spark.sql(f"DROP TABLE {name}")
        remove(spark, path)
        raise
    if target is not None:
        return target
    old = _suffixed(table, f"_managed_{tag}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")
    return table
