"""Which group holds which permission on which object: landed JSON to the permission table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.operators import acl


def flat_permissions(
    listings: DataFrame, acl_documents: DataFrame, secret_documents: DataFrame
) -> DataFrame:
    """Flattened ACLs of all kinds; documents carry (artifact_type, id, doc) and are parsed and
    joined once for all kinds. The single permission of a secret entry becomes a list of one."""
    keys = ["artifact_type", "id"]
    plain = acl.parse_acl(acl_documents).select(*keys, "perms")
    secrets = acl.parse_secret_acl(secret_documents).select(
        *keys,
        F.transform(
            "perms",
            lambda p: F.when(
                p.isNotNull(),
                F.struct(
                    p["group_name"].alias("group_name"), F.array(p["permissions"]).alias("permissions")
                ),
            ),
        ).alias("perms"),
    )
    return acl.flatten_attached(acl.attach_acl(listings, plain.unionByName(secrets)))


def permission_table(
    pages: DataFrame,
    model_ids: DataFrame,
    acl_documents: DataFrame,
    secret_documents: DataFrame,
    group_pages: DataFrame,
    kinds: Sequence[str] = tuple(acl.KINDS),
    of_interest: str | Sequence[str] | None = None,
) -> DataFrame:
    listings = acl.all_listings(pages, model_ids, kinds)
    flat = flat_permissions(listings, acl_documents, secret_documents)
    group_rows = acl.groups(acl.group_listing(group_pages), of_interest)
    return acl.permission_table(flat, group_rows)
