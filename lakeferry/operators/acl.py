"""Workspace-object ACLs: one spec table, eleven object types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lakeferry.functions import REJECTED, grouped_lookup, last_answer, lookup, with_parsed
from lakeferry.schemas import ACL_ENTRIES, PERMISSIONS, SECRET_ACL_ENTRIES


@dataclass(frozen=True)
class Kind:
    """How one object type is listed, stored and addressed."""

    label: str
    listing: str
    name: str
    id: str
    id_column: str
    perms_column: str
    uri: str
    drop_names: str | None = None
    object_type: str | None = None


_PERMISSIONS_API = "/api/2.0/preview/permissions"

# Type names, response fields, column names and endpoints of the eleven types.
KINDS = {
    "Jobs": Kind(
        "Job", "jobs", "settings.name", "job_id", "job_id", "job_perms",
        f"{_PERMISSIONS_API}/jobs/", drop_names="%[RUNNER]%",
    ),
    "Clusters": Kind(
        "Cluster", "clusters", "cluster_name", "cluster_id", "cluster_id", "cluster_perms",
        f"{_PERMISSIONS_API}/clusters/", drop_names="job-%",
    ),
    "Cluster_Policies": Kind(
        "Cluster_Policy", "policies", "name", "policy_id", "policy_id", "policy_perms",
        f"{_PERMISSIONS_API}/cluster-policies/",
    ),
    "Pipelines": Kind(
        "Pipeline", "statuses", "name", "pipeline_id", "pipeline_id", "pipeline_perms",
        f"{_PERMISSIONS_API}/pipelines/",
    ),
    "Pools": Kind(
        "Pool", "instance_pools", "instance_pool_name", "instance_pool_id", "instance_pool_id",
        "pool_perms", f"{_PERMISSIONS_API}/instance-pools/",
    ),
    "SQL_Warehouses": Kind(
        "SQL_Warehouse", "warehouses", "name", "id", "warehouse_id", "warehouse_perms",
        f"{_PERMISSIONS_API}/sql/warehouses/",
    ),
    "MLFlow_Models": Kind(
        "MLFlow_Model", "registered_models", "name", "name", "model_id", "model_perms",
        f"{_PERMISSIONS_API}/registered-models/",
    ),
    "Repos": Kind(
        "Repo", "repos", "path", "id", "repo_id", "repo_perms", f"{_PERMISSIONS_API}/repos/"
    ),
    "Notebooks": Kind(
        "Notebook", "objects", "path", "object_id", "notebook_id", "notebook_perms",
        f"{_PERMISSIONS_API}/notebooks/", object_type="NOTEBOOK",
    ),
    "Directories": Kind(
        "Directory", "objects", "path", "object_id", "directory_id", "directory_perms",
        f"{_PERMISSIONS_API}/directories/", object_type="DIRECTORY",
    ),
    "Secrets": Kind(
        "Secret", "scopes", "name", "name", "id", "scope_perms", "/api/2.0/secrets/acls/put"
    ),
}
SECRETS = "Secrets"
REPOS_ROOT = "/Repos"

# Groups that are never migrated (``_`` is a LIKE wildcard, as it always was).
BUILT_IN_GROUPS = ("admins", "users")
MIGRATED_GROUPS = "uc_%"

# Outcome texts.
PERMISSION_SET = "Permission set Successfully"


def _page_schema(kinds: Sequence[str]) -> str:
    """One schema that holds the list fields of all the kinds."""
    lists: dict[str, dict[str, str]] = {}
    for kind in kinds:
        spec = KINDS[kind]
        fields = lists.setdefault(spec.listing, {})
        outer, _, inner = spec.name.partition(".")
        fields[outer] = f"struct<{inner}:string>" if inner else "string"
        fields[spec.id] = "string"
        if spec.object_type:
            fields["object_type"] = "string"
    columns = (
        f"{name}:array<struct<{','.join(f'{n}:{t}' for n, t in fields.items())}>>"
        for name, fields in lists.items()
    )
    return f"struct<{','.join(columns)}>"


def _listed(document: Column, kind: str) -> Column:
    """The objects of one kind on a page as (artifact_type, name, id)."""
    spec = KINDS[kind]
    items = document[spec.listing]
    if spec.object_type:
        items = F.filter(
            items,
            lambda i: (i["object_type"] == spec.object_type) & ~i["path"].startswith(REPOS_ROOT),
        )

    def named(item: Column) -> Column:
        name = item
        for part in spec.name.split("."):
            name = name[part]
        return F.struct(
            F.lit(spec.label).alias("artifact_type"), name.alias("name"), item[spec.id].alias("id")
        )

    return F.coalesce(
        F.transform(items, named), F.array().cast("array<struct<artifact_type:string,name:string,id:string>>")
    )


def _one_row_per_object(found: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Overlapping pages list an object twice: it stays once. Registered models are listed by name
    and get the id that ``ids`` has for it; a model without one keeps a null id."""
    found = found.dropDuplicates()
    more = [c for c in found.columns if c == REJECTED]
    if ids is None:
        return found
    model = KINDS["MLFlow_Models"]
    known = grouped_lookup(
        ids.select("name", F.col(model.id_column).cast("string").alias("model_id")),
        ["name"],
        F.min("model_id").alias("model_id"),
    )
    is_model = F.col("artifact_type") == model.label
    return found.join(known, "name", "left").select(
        "artifact_type", "name", F.when(is_model, F.col("model_id")).otherwise(F.col("id")).alias("id"), *more
    )


def listing(pages: DataFrame, kind: str, ids: DataFrame | None = None, page: str = "page") -> DataFrame:
    """(artifact_type, name, id) of every object on landed listing pages, one page per row.

    Registered models list names only; ``ids`` (name, model_id) supplies theirs. A page that is
    not valid JSON fails the query, because a skipped page would lose objects.
    """
    document = F.from_json(F.col(page), _page_schema([kind]), {"mode": "FAILFAST"})
    return _one_row_per_object(pages.select(F.inline(_listed(document, kind))), ids)


def all_listings(
    pages: DataFrame,
    ids: DataFrame | None = None,
    kinds: Sequence[str] = tuple(KINDS),
    page: str = "page",
    rejects: bool = False,
) -> DataFrame:
    """The listings of many kinds at once from pages with a ``kind`` column: each page is read and
    parsed once, and gives the objects of its own kind.

    A page that is not valid JSON fails the query; with ``rejects`` it is one row of its kind without
    name and id, its text in ``rejected``.
    """
    chosen = pages.where(F.col("kind").isin(list(kinds))).select("kind", page)
    parsed = with_parsed(chosen, page, _page_schema(kinds), rejects, "doc")
    objects = reduce(
        lambda chain, kind: chain.when(F.col("kind") == kind, _listed(F.col("doc"), kind)), kinds, F
    )
    if not rejects:
        return _one_row_per_object(parsed.select(F.inline(objects)), ids)
    label = reduce(lambda chain, kind: chain.when(F.col("kind") == kind, KINDS[kind].label), kinds, F)
    nothing = F.lit(None).cast("string")
    unread = F.array(F.struct(label.alias("artifact_type"), nothing.alias("name"), nothing.alias("id")))
    rows = F.when(F.col(REJECTED).isNotNull(), unread).otherwise(objects)
    return _one_row_per_object(parsed.select(F.inline(rows), REJECTED), ids)


def parse_acl(df: DataFrame, doc: str = "doc", rejects: bool = False) -> DataFrame:
    """ACL documents to ``perms``: entries of groups with their permission levels.

    A JSON document without a list gives one null entry. A document that is not JSON, such as a
    truncated one, fails the query: read as "no list", its grants would vanish. With ``rejects`` its row
    has one null entry and the document in ``rejected``.
    """
    schema = (
        "struct<access_control_list:array<struct<group_name:string,"
        "all_permissions:array<struct<permission_level:string>>>>>"
    )
    df = with_parsed(df, doc, schema, rejects)
    entries = F.col("_parsed")["access_control_list"]
    groups = F.transform(
        F.filter(entries, lambda e: e["group_name"].isNotNull()),
        lambda e: F.struct(
            e["group_name"].alias("group_name"),
            F.transform(e["all_permissions"], lambda p: p["permission_level"]).alias("permissions"),
        ),
    ).cast(ACL_ENTRIES)
    return df.withColumn("perms", F.coalesce(groups, _null_entry(ACL_ENTRIES))).drop("_parsed")


def parse_secret_acl(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Secret ACL documents to ``perms``; a failed read gives one null entry."""
    schema = "struct<items:array<struct<principal:string,permission:string>>>"
    entries = F.from_json(F.col(doc), schema)["items"]
    principals = F.transform(
        F.filter(entries, lambda e: e["principal"].isNotNull()),
        lambda e: F.struct(
            e["principal"].alias("group_name"), e["permission"].alias("permissions")
        ),
    ).cast(SECRET_ACL_ENTRIES)
    return df.withColumn(
        "perms", F.coalesce(principals, _null_entry(SECRET_ACL_ENTRIES))
    ).drop(doc)


def _null_entry(entries: ArrayType) -> Column:
    return F.array(F.lit(None).cast(entries.elementType))


def attach_acl(objects: DataFrame, acls: DataFrame) -> DataFrame:
    """Objects with their parsed ACL by (artifact_type, id); one without an ACL has a null entry.

    Secrets and the other types keep different entry types, so attach them in separate calls. Of
    documents that landed twice for an object one counts (the largest, if they differ).
    """
    entries = acls.schema["perms"].dataType
    keys = ["artifact_type", "id"]
    joined = objects.join(grouped_lookup(acls, keys, F.max("perms").alias("perms")), keys, "left")
    return joined.select(
        "artifact_type", "name", "id", F.coalesce("perms", _null_entry(entries)).alias("perms")
    )


def flatten_acl(df: DataFrame, kind: str) -> DataFrame:
    """One row per object, group and permission: name, id, group_name, permissions, artifact_type.

    Takes the columns of the kind (``job_id``, ``job_perms``, ...) or the general ``id``/``perms``.
    Null ACLs and empty lists drop out; a null secret entry stays until the group join.
    """
    spec = KINDS[kind]
    id_column = spec.id_column if spec.id_column in df.columns else "id"
    perms = spec.perms_column if spec.perms_column in df.columns else "perms"
    if spec.drop_names is not None:
        df = df.where(~F.col("name").like(spec.drop_names))
    flat = df.select("name", F.col(id_column).cast("string").alias("id"), F.inline(perms))
    if kind != SECRETS:
        flat = flat.withColumn("permissions", F.explode("permissions"))
    return flat.withColumn("artifact_type", F.lit(spec.label))


def flatten_attached(attached: DataFrame) -> DataFrame:
    """All types but secrets at once, from ``attach_acl`` rows: the same rows as flattening each
    type on its own, in one pass over the objects."""
    keep = reduce(
        lambda chain, k: chain.when(F.col("artifact_type") == k.label, ~F.col("name").like(k.drop_names)),
        [k for k in KINDS.values() if k.drop_names is not None],
        F,
    ).otherwise(F.lit(True))
    return (
        attached.where(keep)
        .select("name", "id", F.inline("perms"), "artifact_type")
        .withColumn("permissions", F.explode("permissions"))
        .select("name", "id", "group_name", "permissions", "artifact_type")
    )


def group_listing(pages: DataFrame, page: str = "page") -> DataFrame:
    """(id, displayName) from all landed pages of the group listing."""
    schema = "struct<Resources:array<struct<id:string,displayName:string>>>"
    document = F.from_json(F.col(page), schema, {"mode": "FAILFAST"})
    return pages.select(F.inline(document["Resources"]))


def groups(listed: DataFrame, of_interest: str | Sequence[str] | None = None) -> DataFrame:
    """Group dimension (id, group_name, uc_group_name) without built-in and migrated groups."""
    name = F.col("displayName")
    found = listed.select(
        F.col("id").cast("string").alias("id"),
        name.alias("group_name"),
        name.alias("uc_group_name"),
    )
    if of_interest:
        names = [of_interest] if isinstance(of_interest, str) else list(of_interest)
        found = found.where(F.col("group_name").isin(names))
    return found.where(
        ~F.col("group_name").isin(list(BUILT_IN_GROUPS))
        & ~F.col("group_name").like(MIGRATED_GROUPS)
    )


def permission_table(flat: DataFrame, group_rows: DataFrame) -> DataFrame:
    """Which group holds which permission on which object, with the status still open.

    The join carries no hint: the group side is broadcast when its measured size allows it,
    and otherwise a group that holds most rows is split by adaptive execution. A group that
    overlapping pages list twice counts once.
    """
    joined = flat.join(lookup(group_rows, "group_name", "uc_group_name"), "group_name")
    return joined.select(
        "name",
        "id",
        F.col("group_name").alias("old_group_names"),
        F.col("uc_group_name").alias("new_group_names"),
        F.col("permissions").alias("permission_level"),
        F.lit(None).cast("string").alias("permission_update_status"),
        "artifact_type",
    )


def permission_requests(permissions: DataFrame, host: str) -> DataFrame:
    """Method, uri and JSON body that set each permission row."""
    is_secret = F.col("artifact_type") == KINDS[SECRETS].label
    uris = F.create_map(*[F.lit(t) for k in KINDS.values() for t in (k.label, k.uri)])
    path = F.try_element_at(uris, F.col("artifact_type"))
    uri = F.concat(
        F.lit(f"https://{host}"), path, F.when(is_secret, F.lit("")).otherwise(F.col("id"))
    )
    secret_body = F.to_json(
        F.struct(
            F.col("id").alias("scope"),
            F.col("new_group_names").alias("principal"),
            F.col("permission_level").alias("permission"),
        )
    )
    entry = F.struct(
        F.col("new_group_names").alias("group_name"), F.col("permission_level").alias("permission_level")
    )
    body = F.to_json(F.struct(F.array(entry).alias("access_control_list")))
    return permissions.select(
        "artifact_type",
        "id",
        "new_group_names",
        "permission_level",
        F.when(is_secret, "POST").otherwise("PATCH").alias("method"),
        uri.alias("uri"),
        F.when(is_secret, secret_body).otherwise(body).alias("body"),
    )


#: What names the permission row that a response is for.
ANSWER_KEYS = ("artifact_type", "id", "new_group_names", "permission_level")


def permission_status(permissions: DataFrame, responses: DataFrame) -> DataFrame:
    """Permission rows with the status of their response (artifact_type, id, new_group_names,
    permission_level, status_code, content, answered_at). The last answer counts, so a retry that
    succeeded does; a row without a response keeps its status."""
    keys = list(ANSWER_KEYS)
    answered = last_answer(responses, keys, "status_code", "content")
    code, content = F.col("answer.status_code"), F.col("answer.content")
    status = (
        F.when(F.col("answer").isNull(), F.col("permission_update_status"))
        .when(code == 200, F.lit(PERMISSION_SET))
        .otherwise(F.concat(F.lit("Error: "), F.coalesce(content, F.lit(""))))
    )
    return (
        permissions.join(answered, keys, "left")
        .withColumn("permission_update_status", status)
        .select(*PERMISSIONS.names)
    )


def artifact_counts(listings: DataFrame | Iterable[DataFrame]) -> DataFrame:
    """Objects per type over listings that carry ``artifact_type``."""
    if not isinstance(listings, DataFrame):
        listings = reduce(DataFrame.unionByName, [one.select("artifact_type") for one in listings])
    return listings.groupBy("artifact_type").agg(F.count("*").alias("objects"))
