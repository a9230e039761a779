"""A metastore estate derived from the given tables.

Each relation is one SQL text that Spark and DuckDB both run. Sizes follow ``part``, ``supplier``,
``orders`` and ``lineitem``. About a third of the tables sits in one database and about a third
of the permissions belongs to one group, as skewed estates do.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("part", "supplier", "customer", "orders", "lineitem")

#: Tables whose short rows become long texts or many objects: the bytes of their files say too little of
#: the work in a split.
NARROW = ("part", "supplier", "orders")
SPREAD_ROWS = 50_000


def spread(rows: DataFrame) -> DataFrame:
    """The rows in partitions of about ``SPREAD_ROWS``, however few splits their files make."""
    wanted = -(-rows.count() // SPREAD_ROWS)
    return rows if wanted <= 1 else rows.repartition(wanted)


# Positions are the numbers that part keys are dealt to.
KIND_LABELS = (
    "Job",
    "Cluster",
    "Cluster_Policy",
    "Pipeline",
    "Pool",
    "SQL_Warehouse",
    "MLFlow_Model",
    "Repo",
    "Notebook",
    "Directory",
    "Secret",
)
_LABEL_CASE = " ".join(f"WHEN {n} THEN '{label}'" for n, label in enumerate(KIND_LABELS))


def _group(number: str) -> str:
    """Group name of a supplier number, the same as in groups_raw."""
    return (
        f"CASE {number} WHEN 0 THEN 'admins' WHEN 1 THEN 'users' WHEN 2 THEN 'uc_team' WHEN 3 THEN 'ucab'"
        f" ELSE 'Supplier#' || lpad('' || {number}, 9, '0') END"
    )


# The job-cluster document as SQL text over ``orders``: proxy-user keys at several levels, thirty
# levels down and inside a list, and a number whose spelling must survive.
DEEP = 30
VERSION = "CASE WHEN o_orderkey % 19 = 0 THEN 'custom:x' ELSE (6 + o_orderkey % 9) || '.' || (o_orderkey % 4) || '.x-scala2.12' END"


def job_cluster(stripped: bool, upgraded: str | None = None) -> str:
    """The document as it lands, without proxy-user keys, or upgraded (members put at the end)."""

    def proxy(text: str) -> str:
        return "" if stripped else text

    deep = '{"in":' * DEEP + "{" + proxy('"HADOOP_USER_NAME":"deep",') + '"end":1}' + "}" * DEEP
    members = [
        '"driver":{"zone":"z","disk":{' + proxy('"HADOOP_PROXY_USER":{"a":1}') + "}}",
        None if upgraded else '"data_security_mode":"LEGACY"',
        '"steps":[{"HADOOP_USER_NAME":"kept"}]',
        '"num_workers":\' || (o_orderkey % 5) || \'',
        '"ratio":1.0',
        None if upgraded else '"spark_conf":{"a.b":"1"' + proxy(',"HADOOP_PROXY_USER":"p"') + "}",
        '"spark_env_vars":{' + proxy('"HADOOP_USER_NAME":"u",') + '"MODE":"batch"}',
        f'"nested":{deep}',
        None if upgraded else f'"spark_version":"\' || {VERSION} || \'"',
        upgraded,
    ]
    body = ",".join(m for m in members if m)
    return f"""'{{"job_cluster_key":"nightly","new_cluster":{{{body}}}}}'"""


JOB_CLUSTER = job_cluster(stripped=False)

RELATIONS = {
    "tables_named": """
SELECT p_partkey AS k, p_size AS size, p_brand AS brand,
  CASE WHEN p_size <= 17 THEN 'db_shared' ELSE 'db_' || (p_partkey - p_partkey % 50) END AS database,
  't' || p_partkey AS tableName,
  CASE p_partkey % 4 WHEN 0 THEN 'MANAGED' WHEN 3 THEN 'VIEW' ELSE 'EXTERNAL' END AS Type
FROM part""",
    "tables_base": """
SELECT k, size, brand, database, tableName, Type,
  CASE WHEN Type = 'VIEW' THEN NULL WHEN k % 3 = 0 THEN 'delta' WHEN k % 3 = 1 THEN 'parquet' ELSE 'hive' END AS Provider,
  CASE WHEN Type = 'VIEW' THEN NULL ELSE 's3://bkt-' || (k % 7) || '/' || database || '/' || tableName END AS Location,
  CASE WHEN Type <> 'VIEW' AND k % 3 = 2 THEN 'org.example.Serde' ELSE NULL END AS Serde
FROM tables_named""",
    "tables_raw": """
SELECT database, tableName, false AS isTemporary,
  concat_ws(chr(10), 'Catalog: hive_metastore', 'Database: ' || database, 'Table: ' || tableName, 'Type: ' || Type, 'Provider: ' || Provider, 'Location: ' || Location, 'Serde Library: ' || Serde, 'Schema: root', ' |-- a: integer (nullable = true)', 'Type: not a property', '', '') AS information
FROM tables_base""",
    "databases": """
SELECT DISTINCT database FROM tables_base
UNION ALL SELECT 'empty_' || s_suppkey AS database FROM supplier""",
    "ext_locations": """
SELECT 'loc_' || s_suppkey AS name,
  CASE s_suppkey % 4 WHEN 0 THEN 's3://bkt-' || (s_suppkey % 7) || '/' WHEN 1 THEN 's3://bkt-' || (s_suppkey % 7) || '/db_' || (s_suppkey % 40 * 50) || '/' WHEN 2 THEN 's3://bkt-' || (s_suppkey % 7) || '/db_' || (s_suppkey % 40 * 50) || '/t1/sub' ELSE 'db_' || (s_suppkey % 40 * 50) END AS url
FROM supplier""",
    "tables_index": """
SELECT CASE WHEN (k - k % 50) % 100 = 0 THEN 'cat' ELSE 'hive_metastore' END AS table_catalog,
  CASE WHEN size = 50 THEN 'information_schema' ELSE database END AS table_schema, tableName AS table_name
FROM tables_base""",
    "upgraded": """
SELECT DISTINCT table_schema FROM tables_index
WHERE table_catalog <> 'hive_metastore' AND table_schema <> 'information_schema'""",
    "views_named": """
SELECT database, tableName AS viewName, 'db_' || (k % 40 * 50) AS other, brand
FROM tables_base WHERE Type = 'VIEW'""",
    "views_raw": """
SELECT database, viewName, other,
  'SELECT a.k, `' || database || '`.f(b.k) FROM `hive_metastore`.`' || database || '`.`t1` a JOIN hive_metastore.' || other || '.t2 b ON a.k = b.k JOIN (SELECT * FROM zz.' || other || ' x,' || other || '.t3) c' || chr(10) || 'JOIN (' || other || '.t4) d' AS view_text
FROM views_named""",
    "views_code": """
SELECT database, viewName, other,
  'SELECT ' || chr(39) || 'see ' || other || '.t1 in hive_metastore.' || other || chr(39) || ' AS a, "' || other || '.x" AS b -- it' || chr(39) || 's hive_metastore.' || other || '.t9' || chr(10) || 'FROM hive_metastore.' || other || '.t1 /* JOIN ' || other || '.t3 */ JOIN ' || other || '.t2' AS view_text
FROM views_named""",
    "views_chained": """
SELECT p_partkey AS k, 'db_' || (p_partkey - p_partkey % 5) % 7 AS database, 'w' || p_partkey AS viewName,
  CASE WHEN p_partkey % 50 = 45 THEN 'SELECT * FROM w' || (p_partkey + 4)
    WHEN p_partkey % 5 = 0 THEN 'SELECT ' || chr(39) || 'FROM w' || (p_partkey + 1) || chr(39) || ' AS a -- FROM w' || (p_partkey + 1)
    WHEN p_partkey % 5 = 1 THEN 'SELECT w9.a FROM t1 x, w' || (p_partkey - 1) || ' y /* w' || p_partkey || ' */'
    WHEN p_partkey % 5 = 2 THEN 'SELECT a FROM (SELECT 1 AS a) JOIN hive_metastore.db_' || (p_partkey - p_partkey % 5) % 7 || '.w' || (p_partkey - 1)
    WHEN p_partkey % 5 = 3 THEN 'SELECT * FROM `db_' || (p_partkey - p_partkey % 5) % 7 || '`.`w' || (p_partkey - 1) || '`'
    ELSE 'SELECT * FROM w' || (p_partkey - 1) || ' AS b JOIN w' || (p_partkey - 3) || ' ON 1 = 1' END AS view_text
FROM part""",
    "views_odd": """
SELECT database, viewName, view_text FROM views_raw WHERE viewName LIKE '%7'
UNION ALL SELECT database, 'nul_' || viewName, CAST(NULL AS STRING) FROM views_raw WHERE viewName LIKE '%3'""",
    "renamed_databases": """
SELECT database, CASE WHEN database LIKE '%00' THEN database || '_moved' ELSE CAST(NULL AS STRING) END AS target_database FROM databases""",
    "schema_mapping": """
SELECT DISTINCT database AS src, database || '_new' AS dst FROM tables_base WHERE Provider = 'delta'""",
    "describe_rows": """
SELECT database, tableName, 1 AS ordinal, 'Type' AS col_name, 'int' AS data_type FROM tables_base WHERE brand = 'Brand#7'
UNION ALL SELECT database, tableName, 2, 'a', 'string' FROM tables_base
UNION ALL SELECT database, tableName, 10, '# Detailed Table Information', '' FROM tables_base WHERE brand <> 'Brand#13'
UNION ALL SELECT database, tableName || '_bare', 1, 'a', 'string' FROM tables_base WHERE brand = 'Brand#15'
UNION ALL SELECT database, tableName, 11, 'Type', Type FROM tables_base
UNION ALL SELECT database, tableName, 12, 'Provider', Provider FROM tables_base WHERE Provider IS NOT NULL
UNION ALL SELECT database, tableName, 13, 'Location', Location FROM tables_base WHERE Location IS NOT NULL
UNION ALL SELECT database, tableName, 14, 'Is_managed_location', 'true' FROM tables_base WHERE Type = 'MANAGED'
UNION ALL SELECT database, viewName, 20, 'View Text', view_text FROM views_raw""",
    "describe_errors": """
SELECT database, tableName || '_gone' AS tableName, 'cannot read ' || tableName AS error
FROM tables_base WHERE brand = 'Brand#11'""",
    "target_tables": """
SELECT database, tableName, CASE WHEN brand = 'Brand#3' THEN Location || '_old' ELSE Location END AS Location
FROM tables_base WHERE Provider = 'delta'""",
    "target_landed": """
SELECT database, tableName, Location FROM target_tables
UNION ALL SELECT database, tableName, Location FROM target_tables WHERE tableName LIKE '%5'""",
    "sync_outcomes": """
SELECT database, tableName, 'SUCCESS' AS status_code, CAST(NULL AS STRING) AS message, 2 AS answered_at
FROM tables_base WHERE brand <> 'Brand#9' AND brand <> 'Brand#5' AND Location IS NOT NULL
UNION ALL SELECT database, tableName, 'FAILED', 'boom ' || k, CASE WHEN brand = 'Brand#5' THEN 2 ELSE 1 END
FROM tables_base WHERE brand <> 'Brand#9' AND (brand = 'Brand#5' OR k % 5 = 0) AND Location IS NOT NULL""",
    "status_json": """
SELECT '[{"source_schema":"' || database || '","source_name":"' || tableName || '","source_type":"' || Type || '","target_catalog":"cat","target_schema":"' || database || '","target_name":"' || tableName || '","status_code":"SUCCESS","description":null},{"status_code":"Error","source_schema":"' || database || '","source_name":"' || tableName || '_b","description":"boom ' || k || '"}]' AS doc
FROM tables_base""",
    "failed_databases": """
SELECT database, 'unreadable' AS message FROM databases WHERE database LIKE '%100' OR database LIKE 'empty%1'""",
    "db_grants": """
SELECT 'u' || (k % 10) AS Principal, 'SELECT' AS ActionType, 'DATABASE' AS ObjectType, database AS ObjectName
FROM tables_base WHERE database <> 'db_50'""",
    "tbl_grants": """
SELECT 'u' || (k % 10) AS Principal, CASE WHEN k % 2 = 0 THEN 'OWN' ELSE 'SELECT' END AS ActionType, 'TABLE' AS ObjectType, database || '.' || tableName AS ObjectName, database, tableName
FROM tables_base
UNION ALL SELECT 'u' || (k % 10), 'SELECT', 'DATABASE', database, database, tableName FROM tables_base""",
    "grants_raw": """
SELECT DISTINCT c.c_name AS Principal,
  CASE o.o_orderstatus WHEN 'O' THEN 'OWN' WHEN 'P' THEN 'CREATE_NAMED_FUNCTION' ELSE 'SELECT' END AS ActionType,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'DATABASE' WHEN 1 THEN 'TABLE' ELSE 'FUNCTION' END AS ObjectType,
  CASE WHEN o.o_orderkey % 3 = 1 THEN lower(c.c_mktsegment) || '.t' || (o.o_orderkey % 50) ELSE lower(c.c_mktsegment) END AS ObjectName
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
UNION ALL SELECT '', '', 'DATABASE', 'empty_' || s_suppkey FROM supplier""",
    "chosen_principals": """
SELECT c_name AS Principal FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "outcomes": """
SELECT Principal, CASE WHEN ActionType = 'OWN' THEN 'ALL PRIVILEGES' ELSE ActionType END AS ActionType, ObjectType, ObjectName,
  CASE WHEN ActionType = 'OWN' THEN 'denied' ELSE CAST(NULL AS STRING) END AS message, 2 AS answered_at
FROM grants_raw WHERE ActionType <> 'CREATE_NAMED_FUNCTION'
UNION ALL SELECT Principal, ActionType, ObjectType, ObjectName, 'slow', 1 FROM grants_raw WHERE ActionType = 'SELECT'""",
    "view_outcomes": """
SELECT database, viewName, brand, CASE WHEN brand = 'Brand#5' THEN 'boom ' || viewName ELSE CAST(NULL AS STRING) END AS message
FROM views_named""",
    "view_answers": """
SELECT database, viewName, message, 2 AS answered_at FROM view_outcomes WHERE brand <> 'Brand#9'
UNION ALL SELECT database, viewName, 'slow', 1 FROM view_outcomes WHERE brand = 'Brand#2'""",
    "groups_raw": f"""
SELECT s_suppkey AS id, {_group("s_suppkey")} AS displayName FROM supplier""",
    "group_pages": """
SELECT '{"Resources":[{"id":"' || id || '","displayName":"' || displayName || '","entitlements":[{"value":"x"}]}]}' AS page
FROM groups_raw""",
    "acl_objects": f"""
SELECT l_orderkey AS k, l_orderkey || '-' || l_linenumber AS id, 'object ' || l_partkey AS name, l_linenumber AS line,
  CASE l_partkey % 11 {_LABEL_CASE} END AS label,
  {_group("CASE WHEN l_quantity <= 17 THEN 5 ELSE l_suppkey END")} AS group1, {_group("l_orderkey % 10")} AS group2,
  CASE l_returnflag WHEN 'A' THEN 'CAN_VIEW' WHEN 'N' THEN 'CAN_RUN' ELSE 'CAN_MANAGE' END AS permission1,
  CASE l_linestatus WHEN 'F' THEN 'IS_OWNER' ELSE 'CAN_USE' END AS permission2,
  CASE WHEN l_tax = 0.08 THEN 'unread' WHEN l_discount = 0.1 THEN 'missing' ELSE 'read' END AS state
FROM lineitem""",
    "acl_base": """
SELECT k, id, name, line, label, group1 AS group_name, permission1 AS permission FROM acl_objects WHERE state = 'read'
UNION ALL SELECT k, id, name, line, label, group1, permission2 FROM acl_objects WHERE state = 'read'
UNION ALL SELECT k, id, name, line, label, group2, 'CAN_VIEW' FROM acl_objects WHERE state = 'read' AND line <> 1""",
    "permissions_stored": """
SELECT name, id, group_name AS old_group_names, group_name AS new_group_names, permission AS permission_level, label AS artifact_type
FROM acl_base""",
    "responses": """
SELECT label AS artifact_type, id, group_name AS new_group_names, permission AS permission_level,
  CASE WHEN k % 9 = 0 THEN 403 ELSE 200 END AS status_code, CASE WHEN k % 9 = 0 THEN 'denied ' || k ELSE '' END AS content, 2 AS answered_at
FROM acl_base WHERE label <> 'Repo'
UNION ALL SELECT label, id, group_name, permission, CASE WHEN k % 9 = 0 THEN 200 ELSE 429 END, 'slow', 1
FROM acl_base WHERE label <> 'Repo' AND k % 4 = 0""",
    "jobs_raw": f"""
SELECT o_orderkey AS job_id, CASE WHEN o_orderkey % 17 = 0 THEN '{{"settings":{{"name":"j","job_clusters":[]}}}}'
  WHEN o_orderkey % 23 = 0 THEN '{{"settings":{{"name":"j","job_clusters":[{{"job_cluster_key":"shared"}}]}}}}'
  ELSE '{{"settings":{{"name":"j","job_clusters":[' || {JOB_CLUSTER} || ',{{"job_cluster_key":"second"}}]}}}}' END AS job_json
FROM orders""",
    "job_responses": """
SELECT job_id, CASE WHEN job_id % 5 = 0 THEN 500 ELSE 200 END AS status_code, 'fail ' || job_id AS content, 2 AS answered_at FROM jobs_raw
UNION ALL SELECT job_id, CASE WHEN job_id % 5 = 0 THEN 200 ELSE 500 END, 'slow', 1 FROM jobs_raw WHERE job_id % 3 = 0""",
    "backups": """
SELECT o_orderkey AS job_id, '{"job_cluster_key":"old"}' AS cluster_config, 1 AS recorded_at FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, '{"job_cluster_key":"k' || o_orderkey || '"}', 2 FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, '{''not'': ''JSON''}', 3 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0""",
    "acl_json": """
SELECT p_partkey AS k, CASE WHEN p_size = 50 THEN '{"error_code":"DENIED"}' ELSE '{"access_control_list":[{"group_name":"' || g.displayName || '","all_permissions":[{"permission_level":"CAN_VIEW"},{"permission_level":"CAN_RUN","inherited":true}]},{"user_name":"u' || p_partkey || '","all_permissions":[{"permission_level":"CAN_MANAGE"}]},{"group_name":"' || p_brand || '","all_permissions":[{"permission_level":"CAN_MANAGE"}]}]}' END AS doc
FROM part JOIN groups_raw g ON g.id = p_partkey % 10""",
    "secret_acls": """
SELECT p_partkey AS k, 's' || p_partkey AS id, CASE WHEN p_size = 50 THEN 'no JSON' ELSE '{"items":[{"principal":"' || g.displayName || '","permission":"READ"},{"principal":"users","permission":"MANAGE"},{"permission":"WRITE"}]}' END AS doc
FROM part JOIN groups_raw g ON g.id = p_partkey % 10""",
    "model_ids": """
SELECT 'm' || p_partkey AS name, 'id' || p_partkey AS model_id FROM part WHERE p_size <> 49
UNION ALL SELECT 'm' || p_partkey, 'id' || p_partkey FROM part WHERE p_size = 48""",
}

# One page per part and kind; a page of jobs or workspace objects holds several objects.
PAGES = {
    "Jobs": """'{"jobs":[{"job_id":' || p_partkey || ',"settings":{"name":"j' || p_partkey || '"}},{"job_id":' || (p_partkey + 1000000000000) || ',"settings":{"name":"x [RUNNER]"}}],"has_more":true}'""",
    "Clusters": """'{"clusters":[{"cluster_name":"c' || p_partkey || '","cluster_id":"' || p_partkey || '","state":"RUNNING"}]}'""",
    "Cluster_Policies": """'{"policies":[{"name":"p' || p_partkey || '","policy_id":"' || p_partkey || '"}]}'""",
    "Pipelines": """'{"statuses":[{"name":"d' || p_partkey || '","pipeline_id":"' || p_partkey || '"}],"next_page_token":"n"}'""",
    "Pools": """'{"instance_pools":[{"instance_pool_name":"i' || p_partkey || '","instance_pool_id":"' || p_partkey || '"}]}'""",
    "SQL_Warehouses": """'{"warehouses":[{"name":"w' || p_partkey || '","id":"' || p_partkey || '"}]}'""",
    "MLFlow_Models": """'{"registered_models":[{"name":"m' || p_partkey || '"}]}'""",
    "Repos": """'{"repos":[{"path":"/Repos/r' || p_partkey || '","id":' || p_partkey || '}]}'""",
    "Notebooks": """'{"objects":[{"path":"/Users/n' || p_partkey || '","object_type":"NOTEBOOK","object_id":' || p_partkey || '},{"path":"/Users/d' || p_partkey || '","object_type":"DIRECTORY","object_id":' || p_partkey || '},{"path":"/Repos/n' || p_partkey || '","object_type":"NOTEBOOK","object_id":' || (p_partkey + 2000000000000) || '}]}'""",
    "Secrets": """'{"scopes":[{"name":"s' || p_partkey || '"}]}'""",
}
PAGES["Directories"] = PAGES["Notebooks"]


def _dependencies(sql: str) -> list[str]:
    words = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql))
    return [name for name in RELATIONS if name in words]


def with_clause(sql: str, extra: tuple[str, ...] = ()) -> str:
    """``sql`` with every estate relation it reads, directly or not, as a CTE in front."""
    needed: set[str] = set()
    todo = _dependencies(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _dependencies(RELATIONS[name])
    ctes = [*extra, *(f"{n} AS ({RELATIONS[n].strip()})" for n in RELATIONS if n in needed)]
    return f"WITH {', '.join(ctes)} {sql}" if ctes else sql


class Estate:
    """The estate of one data folder as Spark DataFrames."""

    stored: str | None = None

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._view(name))

    def _view(self, name: str) -> str:
        """Temporary view of one file, so that its footer is read once per session."""
        view = f"estate_{zlib.crc32(self.sf_dir.encode())}_{name}"
        if not self.spark.catalog.tableExists(view):
            rows = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            if name in NARROW:
                rows = spread(rows)
            rows.createTempView(view)
        return view

    def sql(self, sql: str) -> DataFrame:
        query = with_clause(sql)
        read = [t for t in TABLES if re.search(rf"\b(?:FROM|JOIN)\s+{t}\b", query)]
        files = tuple(f"{t} AS (SELECT * FROM {self._view(t)})" for t in read)
        return self.spark.sql(with_clause(sql, files))

    def __getattr__(self, name: str) -> DataFrame:
        if name not in RELATIONS:
            raise AttributeError(name)
        if self.stored is not None:
            return self.spark.read.parquet(f"{self.stored}/{name}")
        return self.sql(f"SELECT * FROM {name}")

    def store(self, folder: str, files: int = 8) -> None:
        """Write every relation once, in several files as landed data comes, so that later queries of
        any estate time operators only."""
        for name in RELATIONS:
            self.sql(f"SELECT * FROM {name}").repartition(files).write.parquet(f"{folder}/{name}")
        Estate.stored = folder

    def pages(self, kind: str) -> DataFrame:
        return self.sql(f"SELECT '{kind}' AS kind, {PAGES[kind]} AS page FROM part")

    def all_pages(self) -> DataFrame:
        """The pages of all kinds from one scan of their source."""
        pages = ", ".join(f"named_struct('kind', '{k}', 'page', {page})" for k, page in PAGES.items())
        return self.sql(f"SELECT inline(array({pages})) FROM part")

    def acl_documents(self, name: str, id_column: str, perms_column: str) -> DataFrame:
        """Every line item as an object with its nested ACL: two groups, or a null entry after a
        failed read, or no list. ``name`` is an SQL expression over the columns of acl_objects."""
        perms = """CASE state
            WHEN 'read' THEN array(
              named_struct('group_name', group1, 'permissions', array(permission1, permission2)),
              named_struct('group_name', group2, 'permissions',
                CASE WHEN line = 1 THEN CAST(array() AS array<string>) ELSE array('CAN_VIEW') END))
            WHEN 'unread' THEN array(NULL) END"""
        return self.acl_objects.select(
            F.expr(name).alias("name"), F.col("id").alias(id_column), F.expr(perms).alias(perms_column)
        )

    def secret_documents(self) -> DataFrame:
        """Every line item as a secret scope; a permission is a single string here."""
        perms = """CASE state
            WHEN 'read' THEN array(
              named_struct('group_name', group1, 'permissions', permission1),
              named_struct('group_name', group2, 'permissions', permission2))
            WHEN 'unread' THEN array(NULL) END"""
        return self.acl_objects.select(
            "id", F.col("id").alias("name"), F.expr(perms).alias("scope_perms")
        )

    def permission_rows(self) -> DataFrame:
        return self.permissions_stored.withColumn(
            "permission_update_status", F.lit(None).cast("string")
        )
