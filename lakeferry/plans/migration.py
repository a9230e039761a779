"""Sync and view upgrade of all databases, and grants from extract to statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakeferry.operators import grants, inventory, sync, views


def table_sync(
    databases: DataFrame,
    snapshot: DataFrame,
    target_tables: DataFrame,
    catalog: str,
    outcomes: DataFrame | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Status of all tables of all databases straight from the listing text."""
    tables = inventory.parse_information(snapshot)
    return sync.sync_status(databases, tables, target_tables, catalog, outcomes, dry_run)


def view_upgrade(
    describe_rows: DataFrame,
    tables_index: DataFrame,
    catalog: str,
    owner: str | None = None,
    databases: DataFrame | None = None,
) -> DataFrame:
    """Ordered statements that recreate every view in the new catalog; ``databases`` may name a
    ``target_database`` for each."""
    definitions = views.view_definitions(describe_rows)
    upgraded = views.upgraded_schemas(tables_index)
    rewritten = views.rewrite_views(definitions, upgraded, catalog, databases=databases)
    return views.view_statements(rewritten, catalog, owner, databases=databases)


def grant_extract(
    databases: DataFrame, schema_grants: DataFrame, object_grants: DataFrame, errors: DataFrame
) -> DataFrame:
    return grants.consolidate_grants(
        grants.database_grants(databases, schema_grants, errors),
        grants.table_grants(databases, object_grants, errors),
    )


def grant_migration(
    databases: DataFrame,
    schema_grants: DataFrame,
    object_grants: DataFrame,
    errors: DataFrame,
    catalog: str,
    outcomes: DataFrame,
    types: Sequence[str] = ("DATABASE",),
) -> DataFrame:
    """From the landed grants to the result of each planned statement."""
    extract = grant_extract(databases, schema_grants, object_grants, errors)
    return grants.grant_results(grants.plan_grants(extract, catalog, types), outcomes)
