"""Table sync: status, statements and collected results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.functions import (
    REJECTED,
    grouped_lookup,
    last_answer,
    lookup,
    quote,
    quoted_literal,
    sql_text,
    with_parsed,
)
from lakeferry.operators.inventory import EMPTY_DATABASE, with_database_column, without_match
from lakeferry.schemas import STATUS

# Our own status codes, next to those that outcomes bring.
DRY_RUN = "DRY_RUN"
NO_OUTCOME = "NO_OUTCOME"
MISSING_LOCATION = "MISSING_LOCATION"


def numbered_statements(df: DataFrame, keys: list, statements: list) -> DataFrame:
    """One row per statement with its step number; null statements (optional parts) drop out."""
    present = F.filter(F.array(*statements), lambda s: s.isNotNull())
    return df.select(*keys, F.posexplode(present).alias("step", "statement")).withColumn(
        "step", F.col("step") + 1
    )


def sync_status(
    databases: DataFrame,
    source_tables: DataFrame,
    target_tables: DataFrame,
    catalog: str,
    outcomes: DataFrame | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Status row per source table against the target catalog.

    Tables carry (database, tableName, Type, Location), targets (database, tableName, Location);
    a table listed twice counts once. ``outcomes`` (database, tableName, status_code, message,
    answered_at) are the landed results of the sync; the last one of a table is its status, and a
    table without one has ``NO_OUTCOME``: the listings say what there is to do, not that it was done.
    ``dry_run`` states the plan only. ``databases`` may carry ``target_database``.
    """
    databases = with_target(databases)
    keys = ["target_schema", "tableName"]
    once = ["database", "tableName"]
    listed = with_database_column(source_tables)
    source = grouped_lookup(
        listed, once, F.min(F.struct("Type", "Location")).alias("_listed")
    ).select(*once, "_listed.Type", "_listed.Location")
    target = grouped_lookup(
        with_database_column(target_tables).withColumnRenamed("database", "target_schema"),
        keys,
        F.min(F.coalesce("Location", F.lit(""))).alias("target_location"),
    )
    joined = source.join(databases, "database").join(target, keys, "left")
    no_location = F.coalesce(F.col("Location"), F.lit("")) == ""
    planned = (
        F.when(no_location, F.lit("No storage location to sync"))
        .when(F.col("target_location").isNull(), F.lit("Create table"))
        .when(F.col("target_location") == F.col("Location"), F.lit("Already in target"))
        .otherwise(F.lit("Replace table: location differs"))
    )
    missing = F.when(no_location, F.lit(MISSING_LOCATION))
    if dry_run or outcomes is None:
        code = missing.otherwise(F.lit(DRY_RUN if dry_run else NO_OUTCOME))
        description = planned
    else:
        last = last_answer(with_database_column(outcomes), once, "status_code", "message")
        joined = joined.join(last, once, "left")
        code = F.coalesce("answer.status_code", missing.otherwise(F.lit(NO_OUTCOME)))
        description = F.coalesce("answer.message", planned)
    rows = joined.select(
        F.col("database").alias("source_schema"),
        F.col("tableName").alias("source_name"),
        F.col("Type").alias("source_type"),
        F.lit(catalog).alias("target_catalog"),
        "target_schema",
        F.col("tableName").alias("target_name"),
        code.alias("status_code"),
        description.alias("description"),
    )
    return rows.unionByName(
        marker_status(databases, with_database_column(source_tables), catalog, EMPTY_DATABASE)
    )


def with_target(databases: DataFrame) -> DataFrame:
    """(database, target_schema), one row a database: its ``target_database``, or its own name where no
    row of it gives one. A database with several targets fails the query."""
    databases = with_database_column(databases)
    if "target_database" not in databases.columns:
        return lookup(databases.select("database"), "database").withColumn("target_schema", F.col("database"))
    named = F.col("target_database")
    targets = grouped_lookup(databases, ["database"], F.min(named).alias("_first"), F.max(named).alias("_last"))
    several = F.raise_error(
        F.format_string("database %s has several targets: %s and %s", "database", "_first", "_last")
    )
    return targets.select(
        "database",
        F.when(F.col("_first") != F.col("_last"), several.cast("string"))
        .otherwise(F.coalesce("_first", "database"))
        .alias("target_schema"),
    )


def marker_status(
    databases: DataFrame, members: DataFrame, catalog: str, description: str
) -> DataFrame:
    """One SUCCESS row for each database without members."""
    empty = without_match(databases, members).join(databases, "database")
    return empty.select(
        F.col("database").alias("source_schema"),
        F.lit("").alias("source_name"),
        F.lit("").alias("source_type"),
        F.lit(catalog).alias("target_catalog"),
        "target_schema",
        F.lit("").alias("target_name"),
        F.lit("SUCCESS").alias("status_code"),
        F.lit(description).alias("description"),
    )


def sync_statements(
    databases: DataFrame,
    catalog: str,
    owner: str | None = None,
    dry_run: bool = False,
    source_catalog: str = "hive_metastore",
    alter_owner: bool = True,
) -> DataFrame:
    """Statements per database in order; ``alter_owner=False`` leaves the database owner alone."""
    cat = quoted_literal(catalog)
    target = sql_text(f"{cat}.", quote(F.col("target_schema")))
    source = sql_text(f"{quoted_literal(source_catalog)}.", quote(F.col("database")))
    no_statement = F.lit(None).cast("string")
    set_owner = f" SET OWNER {quoted_literal(owner)}" if owner is not None else ""
    return numbered_statements(
        with_target(databases),
        ["database"],
        [
            F.lit(f"CREATE CATALOG IF NOT EXISTS {cat}"),
            sql_text("CREATE DATABASE IF NOT EXISTS ", target),
            sql_text("ALTER DATABASE ", target, f" OWNER TO {quoted_literal(owner)}")
            if owner is not None and alter_owner
            else no_statement,
            sql_text(
                "SYNC SCHEMA ", target, " FROM ", source, set_owner, " DRY RUN" if dry_run else ""
            ),
        ],
    )


def collect_status(
    documents: DataFrame, schema=STATUS, doc: str = "doc", rejects: bool = False
) -> DataFrame:
    """All JSON result documents (an array of records each) as one typed table.

    A document that cannot be read fails the query; with ``rejects`` it is one row of nulls with its
    text in ``rejected``.
    """
    record = f"array<{schema.simpleString()}>"
    parsed = with_parsed(documents.select(doc), doc, record, rejects)
    if not rejects:
        return parsed.select(F.inline("_parsed"))
    unread = F.when(F.col(REJECTED).isNotNull(), F.array(F.lit(None).cast(schema)))
    return parsed.select(F.inline(F.coalesce(unread, F.col("_parsed"))), REJECTED)
