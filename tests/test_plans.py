"""Physical plans: what must not be there, what must, and skew handling at work."""

import re

import pytest
from pyspark.sql import functions as F

from lakeferry.operators import acl, grants, views
from lakeferry.session import SETTINGS
from lakeferry.sinks import write_permissions
from workload.catalogue import QUERIES
from workload.estate import Estate

SF_DIR = "/root/testdata/sf0.001"
WRITES = {k for k in QUERIES if k.startswith(("write_", "update_"))} | {
    "externalize",
    "externalize_partitioned",
    "append_grants",
    "backup_configs",
    "stored_permissions_of",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - WRITES))
def test_no_products_no_python_no_single_task(spark, key):
    text = plan(QUERIES[key](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "Window"):
        assert node not in text
    # The list of path shapes is bounded by the longest path; nothing else meets in one task.
    shapes = text.count("collect_set(struct(slash")
    assert text.count("SinglePartition") <= shapes


def test_scan_reads_only_the_columns_of_the_query(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(QUERIES["flatten_jobs"](spark, SF_DIR))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    lineitem = re.search(r"ReadSchema: struct<(l_[^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in lineitem.split(",")} == {
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    }


def test_filters_reach_the_scan(spark):
    grants_table = Estate(spark, SF_DIR).grants_raw
    grants_table.write.mode("overwrite").saveAsTable("plan_grants_in")
    text = plan(grants.securables(spark.table("plan_grants_in"), ("DATABASE", "TABLE")))
    assert "PushedFilters: [In(ObjectType, [DATABASE,TABLE])]" in text
    assert "ReadSchema: struct<ObjectType:string,ObjectName:string>" in text


@pytest.fixture
def no_broadcast(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    text = plan(df)
    return text[: text.find("== Initial Plan ==")]


def hot(spark, n=60000):
    """A third of the rows carry one name."""
    return spark.range(n).repartition(8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("who")
    )


def test_hot_group_is_split(spark, no_broadcast):
    rows = hot(spark)
    flat = rows.select(
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
        F.col("id").cast("string").alias("id"),
        F.col("who").alias("group_name"),
        F.lit("A").alias("permissions"),
        F.lit("Job").alias("artifact_type"),
    )
    names = rows.select(F.col("who").alias("displayName")).distinct().withColumn("id", F.lit(1))
    df = acl.permission_table(flat, acl.groups(names))
    assert "skew=true" in final_plan(df)
    assert df.count() == 60000


def test_hot_database_of_failed_grants_is_split(spark, no_broadcast):
    rows = hot(spark).select(
        F.sha2(F.col("id").cast("string"), 256).alias("Principal"),
        F.lit("SELECT").alias("ActionType"),
        F.lit("TABLE").alias("ObjectType"),
        F.concat("who", F.lit(".t"), "id").alias("ObjectName"),
        F.col("who").alias("database"),
        F.concat(F.lit("t"), "id").alias("tableName"),
    )
    databases = rows.select("database").distinct()
    errors = databases.where("database = 'g1'").withColumn("message", F.lit("no"))
    df = grants.table_grants(databases, rows, errors)
    assert "skew=true" in final_plan(df)
    lost = rows.where("database = 'g1'").count()
    assert df.count() == 60000 - lost + 1


def test_hot_schema_in_view_texts_is_split(spark, no_broadcast):
    rows = hot(spark, 20000).select(
        F.col("who").alias("database"),
        F.concat(F.lit("v"), "id").alias("viewName"),
        F.concat(F.lit("SELECT * FROM "), "who", F.lit(".t JOIN (hot.u) ON "), F.sha2(F.col("id").cast("string"), 256)).alias("view_text"),
    )
    schemas = rows.select(F.col("database").alias("table_schema")).distinct()
    df = views.rewrite_views(rows, schemas, "cat")
    assert "skew=true" in final_plan(df)
    assert df.where("view_text LIKE '% (cat.hot.u)%' AND view_text LIKE '% FROM cat.%'").count() == 20000


def test_pieces_without_a_name_share_no_key(spark):
    df = spark.range(3000).select(
        F.lit("d").alias("database"), F.concat(F.lit("v"), "id").alias("viewName"), F.concat(F.lit("SELECT "), "id").alias("view_text")
    )
    schemas = spark.createDataFrame([("d",)], "table_schema string")
    names = []

    def spy(frame, targets, *rest, join=type(df).join, **more):
        if "name" in frame.columns and "piece" in frame.columns:
            names.extend(r["name"] for r in frame.groupBy("name").count().where("count > 100").collect())
        return join(frame, targets, *rest, **more)

    original = type(df).join
    type(df).join = spy
    try:
        out = views.rewrite_views(df, schemas, "cat")
    finally:
        type(df).join = original
    assert names == []
    assert out.count() == 3000


@pytest.mark.parametrize("key,scans", [("artifact_counts", 2), ("permissions_from_landed", 1)])
def test_pages_are_parsed_in_one_pass(spark, key, scans):
    """Pages of all kinds: one parse of the listing documents for each time they are read."""
    text = plan(QUERIES[key](spark, SF_DIR))
    assert text.count("StructField(instance_pools") <= scans


def test_location_grants_form_no_pairs(spark):
    text = plan(QUERIES["executor_grants"](spark, SF_DIR))
    joins = re.findall(r"(?:SortMergeJoin|HashJoin).*", text)
    assert joins and all("LeftSemi" in j for j in joins if "shorter" in j or "text" in j)


def test_hot_partition_is_written_by_several_tasks(spark, no_broadcast, tmp_path):
    rows = hot(spark).select(
        F.lit("d").alias("name"),
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.lit("g").alias("old_group_names"),
        F.lit("g").alias("new_group_names"),
        F.lit("A").alias("permission_level"),
        F.lit(None).cast("string").alias("permission_update_status"),
        F.when(F.col("id") % 3 == 0, "Job").otherwise(F.concat(F.lit("T"), F.col("id") % 40)).alias("artifact_type"),
    )
    write_permissions(rows, "hot_permissions", str(tmp_path / "hot"))
    assert len(list((tmp_path / "hot" / "artifact_type=Job").glob("*.parquet"))) > 4
    assert spark.table("hot_permissions").count() == 60000


def test_responses_are_shuffled_once_for_their_status(spark, no_broadcast):
    estate = Estate(spark, SF_DIR)
    text = plan(acl.permission_status(estate.permission_rows(), estate.responses))
    assert text.count("Exchange hashpartitioning(") <= 2


def test_settings_are_on(spark):
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value
