import random

import pytest
from pyspark.sql import functions as F

from lakeferry import schemas
from lakeferry.functions import contains_pairs
from lakeferry.operators import externalize, grants, locations
from lakeferry.sinks import write_grants
from lakeferry.sources import grants_table

GRANTS = "Principal string, ActionType string, ObjectType string, ObjectName string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def databases(spark):
    return spark.createDataFrame([("a",), ("b",), ("bad",)], "database string")


@pytest.fixture(scope="module")
def errors(spark):
    return spark.createDataFrame([("bad", "unreadable")], "database string, message string")


def test_database_grants(spark, databases, errors):
    df = spark.createDataFrame(
        [("p", "SELECT", "DATABASE", "a"), ("p", "SELECT", "DATABASE", "bad"), ("p", "OWN", "DATABASE", "zz")],
        GRANTS,
    )
    out = grants.database_grants(databases, df, errors)
    assert out.columns == schemas.GRANTS_WITH_ERROR.names
    assert rows(out) == [
        ("", "", "DATABASE", "b", ""),
        ("", "", "DATABASE", "bad", "unreadable"),
        ("p", "SELECT", "DATABASE", "a", ""),
    ]


def test_table_grants_failure_voids_the_database(spark, databases, errors):
    df = spark.createDataFrame(
        [("p", "OWN", "TABLE", "a.t", "a", "t"), ("p", "OWN", "TABLE", "bad.t", "bad", "t")],
        GRANTS + ", database string, tableName string",
    )
    assert rows(grants.table_grants(databases, df, errors)) == [
        ("", "", "TABLE", "bad", "unreadable"),
        ("p", "OWN", "TABLE", "a.t", ""),
    ]
    named = errors.withColumn("tableName", F.lit("u"))
    assert rows(grants.table_grants(databases, df, named, per_table=True)) == [
        ("", "", "TABLE", "bad", "unreadable"),
        ("p", "OWN", "TABLE", "a.t", ""),
        ("p", "OWN", "TABLE", "bad.t", ""),
    ]


def test_consolidated_grants_are_distinct(spark):
    df = spark.createDataFrame([("p", "a", "t", "o", "")] * 3, schemas.GRANTS_WITH_ERROR)
    assert grants.consolidate_grants(df, df).count() == 1


def planned(spark):
    return spark.createDataFrame(
        [
            ("p", "OWN", "DATABASE", "a"),
            ("q", "CREATE_NAMED_FUNCTION", "DATABASE", "a"),
            ("p", "SELECT", "FUNCTION", "a"),
            ("p", "SELECT", "TABLE", "a.t"),
            ("", "", "DATABASE", "b"),
        ],
        GRANTS,
    )


def test_plan_for_the_new_catalog(spark):
    out = grants.plan_grants(planned(spark), "cat")
    assert sorted(r.statement for r in out.collect()) == [
        "GRANT ALL PRIVILEGES ON SCHEMA `cat`.a TO `p`",
        "GRANT CREATE FUNCTION ON SCHEMA `cat`.a TO `q`",
        "GRANT SELECT ON TABLE `cat`.a TO `p`",
        "GRANT USE CATALOG ON CATALOG `cat` TO `p`",
        "GRANT USE CATALOG ON CATALOG `cat` TO `q`",
    ]
    strict = grants.plan_grants(planned(spark), "cat", strict_types=True)
    assert "GRANT SELECT ON TABLE `cat`.a TO `p`" not in [r.statement for r in strict.collect()]


def test_replay_keeps_privileges_and_principals(spark):
    expected = [
        "GRANT OWN ON SCHEMA `hive_metastore`.a TO `p`",
        "GRANT SELECT ON TABLE `hive_metastore`.a TO `p`",
        "GRANT SELECT ON TABLE `hive_metastore`.a.t TO `p`",
    ]
    by_list = grants.replay_grants(planned(spark), "hive_metastore", ["p"])
    by_table = grants.replay_grants(
        planned(spark), "hive_metastore", spark.createDataFrame([("p",), ("p",)], "Principal string")
    )
    assert sorted(r.statement for r in by_list.collect()) == expected
    assert sorted(r.statement for r in by_table.collect()) == expected


def test_results_carry_messages(spark):
    plan = grants.plan_grants(planned(spark), "cat")
    outcomes = spark.createDataFrame(
        [("p", "ALL PRIVILEGES", "DATABASE", "a", "denied"), ("p", "USE CATALOG", "CATALOG", "cat", None)],
        GRANTS + ", message string",
    )
    out = grants.grant_results(plan, outcomes)
    assert out.count() == plan.count()
    assert rows(out.where("Error <> ''")) == [("p", "ALL PRIVILEGES", "DATABASE", "a", 2, "denied")]
    assert rows(out.where("Error = ''")) == [("p", "USE CATALOG", "CATALOG", "cat", 1, "")]
    assert out.where("Error IS NULL").count() == plan.count() - 2


def test_grant_table_overwrite_and_append(spark):
    df = spark.createDataFrame([("p", "a", "t", "o", "")], schemas.GRANTS_WITH_ERROR)
    write_grants(df, "grants_out")
    write_grants(df, "grants_out")
    assert grants_table(spark, "grants_out").count() == 1
    write_grants(df, "grants_out", "append")
    assert grants_table(spark, "grants_out", ["p"]).count() == 2
    assert grants_table(spark, "grants_out", ["q"]).count() == 0


def tables(spark, *found):
    texts = [("d", t, f"Type: {kind}\nLocation: {loc}\nSchema: root\n") for t, kind, loc in found]
    return spark.createDataFrame(texts, "database string, tableName string, information string")


def test_external_roots(spark):
    df = tables(
        spark,
        ("t1", "EXTERNAL", "s3://b/t1/x/t1"),
        ("t2", "EXTERNAL", "s3://b/t1/x/t2"),
        ("t3", "EXTERNAL", "s3://b/other"),
        ("t4", "MANAGED", "s3://b/managed/t4"),
    )
    assert rows(locations.external_table_roots(df)) == [("s3://b/other",), ("s3://b/t1/x/",)]
    by_regex = locations.external_table_roots(df, literal=False)
    assert ("s3://b//x/",) in rows(by_regex)


def test_match_locations(spark):
    roots = spark.createDataFrame([("s3://b/db/",), ("s3://b/db2/",), (None,)], "Location string")
    ext = spark.createDataFrame(
        [("top", "s3://b/"), ("deep", "s3://b/db/t/x"), ("word", "b/db"), ("no", "gs://b/"), ("twin", "s3://b/")],
        "name string, url string",
    )
    found = {(r.Location, r.name) for r in locations.match_locations(roots, ext).collect()}
    assert found == {
        ("s3://b/db/", "top"),
        ("s3://b/db/", "twin"),
        ("s3://b/db2/", "top"),
        ("s3://b/db2/", "twin"),
        ("s3://b/db/", "deep"),
        ("s3://b/db/", "word"),
        ("s3://b/db2/", "word"),
    }
    strict = {(r.Location, r.name) for r in locations.match_locations(roots, ext, prefix=True).collect()}
    assert strict == {p for p in found if p[1] != "word"}


@pytest.mark.parametrize("prefix", [False, True])
def test_rows_of_one_url_are_dealt_over_tasks(spark, monkeypatch, prefix):
    monkeypatch.setattr(locations, "PART_ROWS", 1000)
    roots = spark.range(200).selectExpr("concat('s3://b/db', id, '/') AS Location")
    ext = spark.range(200).selectExpr("concat('n', id) AS name", "'s3://b/' AS url")
    found = locations.match_locations(roots.unionByName(roots), ext, prefix=prefix)
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == found.distinct().count() == 200 * 200
    assert max(tasks) < 200 * 200 / 3


def test_contains_pairs_against_brute_force(spark):
    rng = random.Random(7)
    texts = lambda n, size: sorted(
        {"".join(rng.choice("ab/") for _ in range(rng.randint(0, size))) for _ in range(n)}
    )
    longer, shorter = texts(60, 9), texts(60, 5)
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "text string")
    out = contains_pairs(frame(longer), frame(shorter)).collect()
    assert len(out) == len(set(out))
    assert {tuple(r) for r in out} == {(a, b) for a in longer for b in shorter if b in a}


def test_executor_grants(spark):
    source = spark.createDataFrame([("s",)], "database string")
    target = spark.createDataFrame([("t",), ("t",)], "database string")
    matches = spark.createDataFrame([("x", "loc", "u"), ("y", "loc", "u")], "Location string, name string, url string")
    out = locations.executor_grants("hms", source, "cat", target, matches, "sv`c")
    assert sorted(r.statement for r in out.collect()) == sorted(
        [
            "GRANT USE_CATALOG ON CATALOG `hms` TO `sv``c` ;",
            "GRANT USE_CATALOG ON CATALOG `cat` TO `sv``c` ;",
            "GRANT USE_SCHEMA ON SCHEMA `hms`.`s` TO `sv``c` ;",
            "GRANT SELECT ON SCHEMA `hms`.`s` TO `sv``c` ;",
            "GRANT USE_SCHEMA ON SCHEMA `cat`.`t` TO `sv``c` ;",
            "GRANT SELECT ON SCHEMA `cat`.`t` TO `sv``c` ;",
            "GRANT CREATE TABLE ON SCHEMA `cat`.`t` TO `sv``c` ;",
            "GRANT MODIFY ON SCHEMA `cat`.`t` TO `sv``c` ;",
            "GRANT CREATE EXTERNAL TABLE ON EXTERNAL LOCATION `loc` TO `sv``c` ;",
        ]
    )


def test_externalize_plan(spark):
    inventory = spark.createDataFrame(
        [("a", "t", "MANAGED", "w/t"), ("a", "v", "VIEW", None), ("b", "t", "MANAGED", "w/b")],
        "database string, tableName string, Type string, Location string",
    )
    chosen = spark.createDataFrame([("a",)], "database string")
    assert rows(externalize.externalize_plan(inventory, chosen)) == [("a", "t", "MANAGED", "EXTERNAL", "w/t")]
    assert rows(externalize.externalize_plan(inventory, chosen, "s3://r/"))[0][-1] == "s3://r/a/t"


def test_externalize_keeps_rows_partitions_and_name(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS ext_test")
    data = spark.range(50).withColumn("part", F.col("id") % 3)
    data.write.partitionBy("part").format("parquet").saveAsTable("ext_test.t")
    before = rows(spark.table("ext_test.t"))
    externalize.externalize(spark, "ext_test.t", str(tmp_path / "copy"), target="ext_test.copied")
    assert spark.catalog.getTable("ext_test.t").tableType == "MANAGED"
    assert spark.catalog.getTable("ext_test.copied").tableType == "EXTERNAL"
    assert rows(spark.table("ext_test.copied")) == before
    externalize.externalize(spark, "ext_test.t", str(tmp_path / "moved"))
    assert spark.catalog.getTable("ext_test.t").tableType == "EXTERNAL"
    assert rows(spark.table("ext_test.t").select("id", "part")) == before
    with pytest.raises(Exception):
        externalize.externalize(spark, "ext_test.t", str(tmp_path / "moved"))
    assert rows(spark.table("ext_test.t").select("id", "part")) == before


def test_content_checksum_ignores_order_only(spark):
    frame = spark.sql(
        "SELECT id, map('a', id, 'b', id + 1) AS m, array(named_struct('x', map(id, 'v'))) AS n, cast(id AS double) AS `d.e` FROM range(50)"
    )
    same = frame.orderBy(frame.id.desc()).selectExpr("id", "map('b', id + 1, 'a', id) AS m", "n", "`d.e`")
    assert externalize.content_checksum(frame) == externalize.content_checksum(same.repartition(3))
    for other in (
        frame.where("id > 0").union(frame.where("id = 1")),
        frame.selectExpr("if(id = 3, 4, id) AS id", "m", "n", "`d.e`"),
        frame.selectExpr("id", "if(id = 3, map('a', 3L, 'b', 5L), m) AS m", "n", "`d.e`"),
        frame.selectExpr("id", "m", "n", "if(id = 3, null, `d.e`) AS `d.e`"),
    ):
        assert externalize.content_checksum(frame) != externalize.content_checksum(other)
    assert externalize.content_checksum(frame.limit(0))[0] == 0


def test_a_failed_copy_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS ext_fail")
    spark.range(5).write.saveAsTable("ext_fail.t")
    sums = iter([(1, None, None), (2, None, None)])
    monkeypatch.setattr(externalize, "content_checksum", lambda rows: next(sums))
    with pytest.raises(RuntimeError, match="differ"):
        externalize.externalize(spark, "ext_fail.t", str(tmp_path / "copy"))
    assert not (tmp_path / "copy").exists()
    assert [r.tableName for r in spark.sql("SHOW TABLES IN ext_fail").collect()] == ["t"]
    assert spark.table("ext_fail.t").count() == 5
    spark.sql("DROP DATABASE ext_fail CASCADE")
