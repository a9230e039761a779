import pytest
from pyspark.sql import functions as F

from lakeferry import schemas
from lakeferry.operators import inventory, sync
from lakeferry.sinks import tables, write_inventory
from lakeferry.sources import stored_inventory, table_snapshot

INFO = (
    "Database: d\nTable: t\nType: MANAGED\nProvider: delta\nLocation: file:/w/d/t\n"
    "Comment: Location: elsewhere\nSchema: root\n |-- Type: string\nType: no property\n\n"
)


def listing(spark, *rows):
    return spark.createDataFrame(
        list(rows), "database string, tableName string, isTemporary boolean, information string"
    )


def test_information_values(spark):
    row = inventory.parse_information(listing(spark, ("d", "t", False, INFO))).first()
    assert row.asDict() == {
        "database": "d",
        "tableName": "t",
        "isTemporary": "false",
        "Type": "MANAGED",
        "Provider": "delta",
        "Location": "file:/w/d/t",
        "Serde Library": None,
        "Error": "",
    }


def test_information_untrimmed_keeps_the_blank(spark):
    df = inventory.parse_information(listing(spark, ("d", "t", False, INFO)), trim=False)
    assert df.first()["Type"] == " MANAGED"


def test_last_line_of_a_key_wins_whatever_the_map_policy(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    text = "Type: VIEW\n\n\nType: MANAGED\n"
    assert inventory.parse_information(listing(spark, ("d", "t", True, text))).first()["Type"] == "MANAGED"


def test_null_information(spark):
    row = inventory.parse_information(listing(spark, ("d", "t", False, None))).first()
    assert row["Type"] is None and row["Error"] == ""


@pytest.mark.parametrize("name", ["database", "namespace", "databaseName"])
def test_database_column_names(spark, name):
    df = listing(spark, ("d", "t", False, INFO)).withColumnRenamed("database", name)
    assert inventory.listings(df, "table").columns[0] == "database"
    assert inventory.listings(df, "database").collect() == [("d",)]


def test_landed_snapshot_with_namespace_column(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    listing(spark, ("d", "t", False, INFO)).withColumnRenamed("database", "namespace").write.parquet(path)
    assert inventory.parse_information(table_snapshot(spark, path)).first()["Type"] == "MANAGED"


def test_listing_kinds(spark):
    df = listing(
        spark, ("d", "t", False, INFO), ("d", "v", False, INFO.replace("MANAGED", "VIEW"))
    )
    assert inventory.listings(df, "table").count() == 2
    assert [r.viewName for r in inventory.listings(df, "view").collect()] == ["v"]
    with pytest.raises(ValueError):
        inventory.listings(df, "other")


def test_empty_database_row(spark):
    databases = spark.createDataFrame([("d",), ("e",), ("e",)], "database string")
    df = inventory.metastore_inventory(databases, listing(spark, ("d", "t", False, INFO)))
    assert df.columns == schemas.INVENTORY.names
    assert [tuple(r) for r in df.where("database = 'e'").collect()] == [
        ("e", "", "", "", "", "", "", "Empty Database")
    ]


def test_table_details_reads_below_the_marker_and_first_wins(spark):
    rows = [
        ("d", "t", 1, "Type", "int"),
        ("d", "t", 2, "# Detailed Table Information", ""),
        ("d", "t", 3, "Type", "EXTERNAL"),
        ("d", "t", 4, "Type", "later"),
        ("d", "t", 5, "Location", "s3://a"),
        ("d", "u", 1, "Type", "int"),
        ("d", "u", 2, "# Detailed Table Information", ""),
    ]
    df = spark.createDataFrame(
        rows, "database string, tableName string, ordinal int, col_name string, data_type string"
    )
    errors = spark.createDataFrame([("d", "x", "gone")], "database string, tableName string, error string")
    out = {r.tableName: r for r in inventory.table_details(df, errors).collect()}
    assert inventory.table_details(df).columns == schemas.TABLE_DETAILS.names
    assert (out["t"].table_type, out["t"].storage_location, out["t"].managed) == (
        "EXTERNAL",
        "s3://a",
        "False",
    )
    assert out["u"].table_type is None
    assert (out["x"].error, out["x"].managed) == ("gone", "False")


def test_copy_required(spark):
    rows = [
        ("EXTERNAL", "dbfs:/x", True),
        ("EXTERNAL", "dbfs:/mnt/x", False),
        ("EXTERNAL", "wasbs://c@a/x", True),
        ("MANAGED", "s3://x", True),
        ("EXTERNAL", "s3://x", False),
        (None, None, False),
    ]
    df = spark.createDataFrame(rows, "Type string, Location string, expected boolean")
    assert inventory.copy_required(df).where("should_copy <> expected").count() == 0


def test_inventory_write_is_one_folder_per_database_and_fails_twice(spark, tmp_path):
    databases = spark.createDataFrame([("d",), ("e",)], "database string")
    df = inventory.metastore_inventory(databases, listing(spark, ("d", "t", False, INFO)))
    path = str(tmp_path / "inventory")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    write_inventory(df, path)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == before
    folders = sorted(p.name for p in (tmp_path / "inventory").iterdir() if p.is_dir())
    assert folders == ["database=d", "database=e"]
    assert stored_inventory(spark, path).schema == schemas.INVENTORY
    assert set(stored_inventory(spark, path).collect()) == set(df.collect())
    with pytest.raises(Exception, match="(?i)exist"):
        write_inventory(df, path)


def test_inventory_write_deals_databases_over_tasks_however_few_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "DATABASES_A_TASK", 10)
    monkeypatch.setattr(tables, "ROWS_A_FILE", 50)
    named = [(f"d{i}", "t", False, INFO) for i in range(60)] + [("hot", f"t{i}", False, INFO) for i in range(400)]
    df = inventory.metastore_inventory(spark.createDataFrame([("none",)], "database string"), listing(spark, *named))
    path = tmp_path / "inventory"
    write_inventory(df, str(path))
    assert sorted(stored_inventory(spark, str(path)).collect()) == sorted(df.collect())
    parts = {f: f.name.split("-")[1] for f in path.rglob("part-*.parquet")}
    assert len(set(parts.values())) >= 4
    assert len({n for f, n in parts.items() if f.parent.name == "database=hot"}) >= 2
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 256


def sync_inputs(spark):
    databases = spark.createDataFrame(
        [("a", None), ("b", "b2"), ("c", None)], "database string, target_database string"
    )
    source = spark.createDataFrame(
        [("a", "t1", "EXTERNAL", "s3://1"), ("a", "v", "VIEW", None), ("b", "t2", "MANAGED", "s3://2")],
        "database string, tableName string, Type string, Location string",
    )
    target = spark.createDataFrame(
        [("a", "t1", "s3://1"), ("b2", "t2", "s3://other")],
        "database string, tableName string, Location string",
    )
    return databases, source, target


def test_sync_status(spark):
    outcomes = spark.createDataFrame(
        [("b", "t2", "FAILED", "early", 1), ("b", "t2", "SUCCESS", None, 2)],
        "database string, tableName string, status_code string, message string, answered_at int",
    )
    df = sync.sync_status(*sync_inputs(spark), "cat", outcomes)
    assert df.columns == schemas.STATUS.names
    assert {r.status_code for r in sync.sync_status(*sync_inputs(spark), "cat").where("source_name <> ''").collect()} == {
        "NO_OUTCOME",
        "MISSING_LOCATION",
    }
    assert {tuple(r) for r in df.collect()} == {
        ("a", "t1", "EXTERNAL", "cat", "a", "t1", "NO_OUTCOME", "Already in target"),
        ("a", "v", "VIEW", "cat", "a", "v", "MISSING_LOCATION", "No storage location to sync"),
        ("b", "t2", "MANAGED", "cat", "b2", "t2", "SUCCESS", "Replace table: location differs"),
        ("c", "", "", "cat", "c", "", "SUCCESS", "Empty Database"),
    }


def test_sync_statements_order_and_optional_parts(spark):
    databases = spark.createDataFrame([("d`b",)], "database string")
    full = sync.sync_statements(databases, "cat", "own", dry_run=True).orderBy("step").collect()
    assert [r.statement for r in full] == [
        "CREATE CATALOG IF NOT EXISTS `cat`",
        "CREATE DATABASE IF NOT EXISTS `cat`.`d``b`",
        "ALTER DATABASE `cat`.`d``b` OWNER TO `own`",
        "SYNC SCHEMA `cat`.`d``b` FROM `hive_metastore`.`d``b` SET OWNER `own` DRY RUN",
    ]
    older = sync.sync_statements(databases, "cat", "own", alter_owner=False).collect()
    assert [r.step for r in older] == [1, 2, 3]
    assert older[2].statement.endswith("SET OWNER `own`")
    bare = sync.sync_statements(databases, "cat").collect()
    assert not any("OWNER" in r.statement for r in bare)


def test_collect_status_ignores_key_order_and_fails_on_broken_documents(spark):
    docs = spark.createDataFrame(
        [('[{"status_code":"Error","source_schema":"s"},{"source_schema":"r"}]',), ("[]",)], "doc string"
    )
    out = sync.collect_status(docs).select("source_schema", "status_code").collect()
    assert sorted(map(tuple, out)) == [("r", None), ("s", "Error")]
    with pytest.raises(Exception):
        sync.collect_status(spark.createDataFrame([("[{",)], "doc string")).collect()


def test_hot_database_in_inventory_and_sync(spark):
    """A third of all tables in one database; nothing is lost and the marker rows stay right."""
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id"))).alias("database"),
        F.concat(F.lit("t"), "id").alias("tableName"),
        F.lit(False).alias("isTemporary"),
        F.lit(INFO).alias("information"),
    )
    databases = hot.select("database").distinct()
    assert inventory.metastore_inventory(databases, hot).count() == 3000


def test_described_tables_without_labels_or_marker_stay(spark):
    df = spark.createDataFrame(
        [("d", "bare", 1, "a", "string"), ("d", "no_marker", 1, "Type", "MANAGED"), ("d", "no_marker", 2, "Location", "s3://a")],
        "database string, tableName string, ordinal int, col_name string, data_type string",
    )
    out = {r.tableName: r for r in inventory.table_details(df).collect()}
    assert out["bare"].table_type is None and out["bare"].managed == "False"
    assert (out["no_marker"].table_type, out["no_marker"].storage_location) == ("MANAGED", "s3://a")


def test_tables_listed_twice_have_one_status(spark):
    databases, source, target = sync_inputs(spark)
    df = sync.sync_status(databases, source.union(source), target.union(target), "cat")
    assert df.count() == 4
