"""Object grants: extraction table, plans for the new and the old catalog, results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions import grouped_lookup, last_answer, lookup, quote, quoted_literal, sql_text
from lakeferry.operators.inventory import with_database_column
from lakeferry.schemas import GRANTS, GRANTS_WITH_ERROR

# Privileges whose name differs in the new catalog.
RENAMED_PRIVILEGES = {"OWN": "ALL PRIVILEGES", "CREATE_NAMED_FUNCTION": "CREATE FUNCTION"}


def _sentinels(databases: DataFrame, object_type: str, error: Column) -> DataFrame:
    return databases.select(
        F.lit("").alias("Principal"),
        F.lit("").alias("ActionType"),
        F.lit(object_type).alias("ObjectType"),
        F.col("database").alias("ObjectName"),
        error.alias("Error"),
    )


def _errors(errors: DataFrame) -> DataFrame:
    return grouped_lookup(
        with_database_column(errors), ["database"], F.min("message").alias("message")
    )


def database_grants(databases: DataFrame, grants: DataFrame, errors: DataFrame) -> DataFrame:
    """Grants on each database; without grants, or after a failed read, one sentinel row.

    ``errors`` has (database, message). The grant rows stay on the streamed side of semi joins,
    so one database owning most of them can be split; only database names are sentinels' input.
    """
    databases = lookup(with_database_column(databases), "database")
    errors = _errors(errors)
    readable = databases.join(errors, "database", "left_anti")
    granted = grants.join(
        lookup(readable.withColumnRenamed("database", "ObjectName"), "ObjectName"),
        "ObjectName",
        "left_semi",
    ).select(*GRANTS.names, F.lit("").alias("Error"))
    owners = grants.select(F.col("ObjectName").alias("database")).distinct()
    silent = readable.join(owners, "database", "left_anti")
    failed = databases.join(errors, "database")
    return granted.unionByName(_sentinels(silent, "DATABASE", F.lit(""))).unionByName(
        _sentinels(failed, "DATABASE", F.col("message"))
    )


def table_grants(
    databases: DataFrame, grants: DataFrame, errors: DataFrame, per_table: bool = False
) -> DataFrame:
    """Grants read table by table (grants carry the database and tableName they were read for).

    A failure voids every row of its database and leaves one sentinel; a database without tables
    gives no row. ``per_table=True`` keeps the rows of the other tables; ``errors`` then names
    the table that failed as well.
    """
    databases = lookup(with_database_column(databases), "database")
    grants = with_database_column(grants)
    if per_table:
        good = grants.join(
            lookup(with_database_column(errors), "database", "tableName"),
            ["database", "tableName"],
            "left_anti",
        )
    else:
        good = grants.join(_errors(errors), "database", "left_anti")
    rows = good.join(databases, "database", "left_semi").select(
        *GRANTS.names, F.lit("").alias("Error")
    )
    failed = databases.join(_errors(errors), "database")
    return rows.unionByName(_sentinels(failed, "TABLE", F.col("message")))


def consolidate_grants(*extracts: DataFrame) -> DataFrame:
    """All extracts with duplicates on the five columns removed (combined before the shuffle)."""
    columns = GRANTS_WITH_ERROR.names
    rows = reduce(DataFrame.unionByName, [e.select(*columns) for e in extracts])
    return rows.dropDuplicates(columns)


def securables(grants: DataFrame, types: Sequence[str] = ("DATABASE",)) -> DataFrame:
    return grants.where(F.col("ObjectType").isin(list(types))).select("ObjectName").distinct()


def _planned(grants: DataFrame, types: Sequence[str], strict_types: bool) -> DataFrame:
    """Rows of the chosen objects. The types choose object names; every row of such a name is
    taken whatever its own type, unless ``strict_types``. Sentinel rows are no grants."""
    rows = grants.where(F.col("Principal") != "")
    if strict_types:
        return rows.where(F.col("ObjectType").isin(list(types)))
    return rows.join(
        lookup(securables(grants, types), "ObjectName"), "ObjectName", "left_semi"
    )


def _grant_statement(catalog: str) -> Column:
    securable = F.when(F.col("ObjectType") == "DATABASE", "SCHEMA").otherwise("TABLE")
    return sql_text(
        "GRANT ",
        F.col("ActionType"),
        " ON ",
        securable,
        f" {quoted_literal(catalog)}.",
        F.col("ObjectName"),
        " TO ",
        quote(F.col("Principal")),
    )


def plan_grants(
    grants: DataFrame,
    catalog: str,
    types: Sequence[str] = ("DATABASE",),
    strict_types: bool = False,
) -> DataFrame:
    """Grant statements for the new catalog, and one USE CATALOG grant per principal first
    (``step`` 1, the object grants are ``step`` 2)."""
    action = reduce(
        lambda chain, pair: chain.when(F.col("ActionType") == pair[0], pair[1]),
        RENAMED_PRIVILEGES.items(),
        F,
    ).otherwise(F.col("ActionType"))
    rows = _planned(grants, types, strict_types).withColumn("ActionType", action)
    objects = rows.select(
        *GRANTS.names, F.lit(2).alias("step"), _grant_statement(catalog).alias("statement")
    )
    entry = (
        rows.select("Principal")
        .distinct()
        .select(
            "Principal",
            F.lit("USE CATALOG").alias("ActionType"),
            F.lit("CATALOG").alias("ObjectType"),
            F.lit(catalog).alias("ObjectName"),
            F.lit(1).alias("step"),
            sql_text(
                f"GRANT USE CATALOG ON CATALOG {quoted_literal(catalog)} TO ",
                quote(F.col("Principal")),
            ).alias("statement"),
        )
    )
    return objects.unionByName(entry)


def replay_grants(
    grants: DataFrame,
    catalog: str,
    principals: Sequence[str] | DataFrame,
    types: Sequence[str] = ("DATABASE", "TABLE"),
    strict_types: bool = False,
) -> DataFrame:
    """Grant statements for the old catalog: chosen principals only, privileges verbatim.

    ``principals`` is a list, or a DataFrame with a ``Principal`` column when there are many.
    """
    grants = grants.where(F.col("Principal") != "")
    if isinstance(principals, DataFrame):
        chosen = grants.join(lookup(principals, "Principal"), "Principal", "left_semi")
    else:
        chosen = grants.where(F.col("Principal").isin(list(principals)))
    return _planned(chosen, types, strict_types).select(
        *GRANTS.names, _grant_statement(catalog).alias("statement")
    )


def grant_results(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Planned grants with ``step`` and the last outcome of each (outcomes: the planned Principal,
    ActionType, ObjectType, ObjectName, a message or null, answered_at): ``''`` on success, the
    message of a failure, null where no outcome tells that the statement ran."""
    last = last_answer(outcomes, GRANTS.names, "message")
    error = F.when(F.col("answer").isNotNull(), F.coalesce("answer.message", F.lit("")))
    return plan.join(last, GRANTS.names, "left").select(*GRANTS.names, "step", error.alias("Error"))
