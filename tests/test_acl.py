import time
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry import schemas, sinks, sources
from lakeferry.operators import acl
from lakeferry.session import CLEANUP
from lakeferry.sinks import update_permissions, write_permissions
from lakeferry.sources import json_pages, permissions_of

ENTRY = "array<struct<group_name:string,permissions:array<string>>>"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_eleven_kinds():
    assert len(acl.KINDS) == 11
    assert len({k.label for k in acl.KINDS.values()}) == 11


def test_listing_of_jobs_over_pages(spark):
    pages = spark.createDataFrame(
        [
            ('{"jobs":[{"job_id":12345678901234,"settings":{"name":"a"}},{"job_id":2,"settings":{"name":"b"}}],"has_more":true}',),
            ('{"jobs":[{"job_id":3,"settings":{"name":"c"},"creator":"x"}],"has_more":false}',),
            ('{"has_more":false}',),
        ],
        "page string",
    )
    assert rows(acl.listing(pages, "Jobs")) == [
        ("Job", "a", "12345678901234"),
        ("Job", "b", "2"),
        ("Job", "c", "3"),
    ]


def test_broken_page_fails(spark):
    with pytest.raises(Exception):
        acl.listing(spark.createDataFrame([('{"jobs":[',)], "page string"), "Jobs").collect()


def test_workspace_tree(spark):
    page = (
        '{"objects":[{"path":"/a","object_type":"DIRECTORY","object_id":1},'
        '{"path":"/a/n","object_type":"NOTEBOOK","object_id":2},'
        '{"path":"/Repos/n","object_type":"NOTEBOOK","object_id":3},'
        '{"path":"/a/f","object_type":"FILE","object_id":4}]}'
    )
    pages = spark.createDataFrame([(page,)], "page string")
    assert rows(acl.listing(pages, "Notebooks")) == [("Notebook", "/a/n", "2")]
    assert rows(acl.listing(pages, "Directories")) == [("Directory", "/a", "1")]


def test_models_get_their_id_by_name(spark):
    pages = spark.createDataFrame([('{"registered_models":[{"name":"m"}]}',)], "page string")
    ids = spark.createDataFrame([("m", "77"), ("other", "78")], "name string, model_id string")
    assert rows(acl.listing(pages, "MLFlow_Models", ids)) == [("MLFlow_Model", "m", "77")]


def test_secret_scope_name_is_its_id(spark):
    pages = spark.createDataFrame([('{"scopes":[{"name":"s"}]}',)], "page string")
    assert rows(acl.listing(pages, "Secrets")) == [("Secret", "s", "s")]


def test_parse_acl(spark):
    docs = spark.createDataFrame(
        [
            (1, '{"access_control_list":[{"group_name":"g","all_permissions":[{"permission_level":"A","inherited":true},{"permission_level":"B"}]},{"user_name":"u","all_permissions":[]}]}'),
            (2, '{"access_control_list":[]}'),
            (3, "{}"),
            (4, None),
        ],
        "id int, doc string",
    )
    out = acl.parse_acl(docs)
    assert out.schema["perms"].dataType.simpleString() == schemas.ACL_ENTRIES.simpleString()
    found = {r.id: r.perms for r in out.collect()}
    assert [tuple(p) for p in found[1]] == [("g", ["A", "B"])]
    assert found[2] == [] and found[3] == [None] and found[4] == [None]


def test_parse_secret_acl(spark):
    docs = spark.createDataFrame(
        [(1, '{"items":[{"principal":"g","permission":"READ"},{"permission":"WRITE"}]}'), (2, "no JSON")],
        "id int, doc string",
    )
    out = acl.parse_secret_acl(docs)
    assert out.schema["perms"].dataType.simpleString() == schemas.SECRET_ACL_ENTRIES.simpleString()
    found = {r.id: r.perms for r in out.collect()}
    assert [tuple(p) for p in found[1]] == [("g", "READ")]
    assert found[2] == [None]


def test_attach_is_by_key_not_by_position(spark):
    objects = spark.createDataFrame(
        [("Job", "a", "1"), ("Repo", "b", "1"), ("Job", "c", "3")], "artifact_type string, name string, id string"
    )
    acls = spark.createDataFrame(
        [("Repo", "1", [("r", ["X"])]), ("Job", "1", [("j", ["Y"])])], f"artifact_type string, id string, perms {ENTRY}"
    )
    found = {r.name: r.perms for r in acl.attach_acl(objects, acls).collect()}
    assert found["a"][0].group_name == "j" and found["b"][0].group_name == "r" and found["c"] == [None]


def flat_input(spark, id_column, perms_column):
    data = [
        ("plain", "1", [("g", ["A", "B"]), ("h", [])]),
        ("x [RUNNER] y", "2", [("g", ["A"])]),
        ("job-7", "3", [("g", ["A"])]),
        (None, "4", [("g", ["A"])]),
        ("none", "5", [None]),
        ("null", "6", None),
    ]
    return spark.createDataFrame(data, f"name string, {id_column} string, {perms_column} {ENTRY}")


@pytest.mark.parametrize("kind", [k for k in acl.KINDS if k != "Secrets"])
def test_flatten(spark, kind):
    spec = acl.KINDS[kind]
    out = acl.flatten_acl(flat_input(spark, spec.id_column, spec.perms_column), kind)
    assert out.columns == ["name", "id", "group_name", "permissions", "artifact_type"]
    found = {(r.id, r.permissions) for r in out.collect()}
    expected = {("1", "A"), ("1", "B"), ("2", "A"), ("3", "A"), ("4", "A")}
    if kind == "Jobs":
        expected -= {("2", "A"), ("4", "A")}
    if kind == "Clusters":
        expected -= {("3", "A"), ("4", "A")}
    assert found == expected
    assert {r.artifact_type for r in out.collect()} == {spec.label}


def test_flatten_of_all_types_equals_one_by_one(spark):
    kinds = [k for k in acl.KINDS if k != "Secrets"]
    single = [acl.flatten_acl(flat_input(spark, "id", "perms"), k) for k in kinds]
    mixed = [
        flat_input(spark, "id", "perms").withColumn("artifact_type", F.lit(acl.KINDS[k].label))
        for k in kinds
    ]
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    together = acl.flatten_attached(union(mixed))
    assert together.columns == single[0].columns
    assert rows(together) == rows(union(single))


def test_flatten_secrets_explodes_once_and_keeps_null_entries(spark):
    df = spark.createDataFrame(
        [("s", "s", [("g", "READ")]), ("t", "t", [None])],
        "id string, name string, scope_perms array<struct<group_name:string,permissions:string>>",
    )
    assert rows(acl.flatten_acl(df, "Secrets")) == [
        ("s", "s", "g", "READ", "Secret"),
        ("t", "t", None, None, "Secret"),
    ]


def group_rows(spark, **options):
    names = ["admins", "users", "uc_a", "ucab", "uc", "dev", None]
    df = spark.createDataFrame(list(enumerate(names)), "id int, displayName string")
    return acl.groups(df, **options)


def test_groups(spark):
    assert [r.group_name for r in group_rows(spark).orderBy("id").collect()] == ["uc", "dev"]
    assert group_rows(spark).columns == schemas.GROUPS.names
    assert [r.group_name for r in group_rows(spark, of_interest="dev").collect()] == ["dev"]
    assert group_rows(spark, of_interest=["dev", "admins"]).count() == 1
    assert group_rows(spark, of_interest=[]).count() == 2


def test_group_pages_are_all_read(spark):
    pages = spark.createDataFrame(
        [('{"Resources":[{"id":"1","displayName":"a","meta":{}}]}',), ('{"Resources":[{"id":"2","displayName":"b"}]}',)],
        "page string",
    )
    assert acl.group_listing(pages).count() == 2


def permission_rows(spark):
    flat = spark.createDataFrame(
        [("n", "1", "dev", "A", "Job"), ("s", "s", "dev", "READ", "Secret"), ("n", "1", "gone", "A", "Job"), ("r", "9", "uc", "B", "Repo")],
        "name string, id string, group_name string, permissions string, artifact_type string",
    )
    return acl.permission_table(flat, group_rows(spark))


def test_permission_table(spark):
    out = permission_rows(spark)
    assert out.columns == schemas.PERMISSIONS.names
    assert out.count() == 3
    assert {r.permission_update_status for r in out.collect()} == {None}


def test_requests(spark):
    found = {r.artifact_type: r for r in acl.permission_requests(permission_rows(spark), "h").collect()}
    assert (found["Job"].method, found["Job"].uri, found["Job"].body) == (
        "PATCH",
        "https://h/api/2.0/preview/permissions/jobs/1",
        '{"access_control_list":[{"group_name":"dev","permission_level":"A"}]}',
    )
    assert (found["Secret"].method, found["Secret"].uri, found["Secret"].body) == (
        "POST",
        "https://h/api/2.0/secrets/acls/put",
        '{"scope":"s","principal":"dev","permission":"READ"}',
    )


def responses(spark):
    return spark.createDataFrame(
        [("Job", "1", "dev", "A", 200, ""), ("Secret", "s", "dev", "READ", 403, "denied")],
        "artifact_type string, id string, new_group_names string, permission_level string, status_code int, content string",
    )


def test_status(spark):
    found = {r.artifact_type: r.permission_update_status for r in acl.permission_status(permission_rows(spark), responses(spark)).collect()}
    assert found == {"Job": "Permission set Successfully", "Secret": "Error: denied", "Repo": None}


def test_stored_permissions_are_replaced_by_type(spark):
    table = "permissions_out"
    write_permissions(permission_rows(spark), table)
    write_permissions(permission_rows(spark), table)
    assert rows(spark.table(table)) == rows(permission_rows(spark))
    renamed = permission_rows(spark).where("artifact_type = 'Job'").withColumn("name", F.lit("new"))
    write_permissions(renamed, table)
    assert {r.artifact_type: r.name for r in spark.table(table).collect()} == {"Job": "new", "Secret": "s", "Repo": "r"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    update_permissions(spark, table, responses(spark))
    found = {r.artifact_type: r.permission_update_status for r in spark.table(table).collect()}
    assert found == {"Job": "Permission set Successfully", "Secret": "Error: denied", "Repo": None}


def test_reading_one_type_prunes_partitions(spark):
    write_permissions(permission_rows(spark), "permissions_pruned")
    plan = permissions_of(spark, "permissions_pruned", ["Job"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(artifact_type" in plan or "PartitionFilters: [(artifact_type" in plan


def test_counts(spark):
    listings = [spark.createDataFrame([(t,)] * n, "artifact_type string") for t, n in (("Job", 2), ("Pool", 3))]
    assert rows(acl.artifact_counts(listings)) == [("Job", 2), ("Pool", 3)]


def test_landed_pages(spark, tmp_path):
    for kind, names in (("Jobs", ("a.json", "b.json")), ("Pools", ("c.json",))):
        folder = tmp_path / f"kind={kind}"
        folder.mkdir()
        for i, n in enumerate(names):
            (folder / n).write_text('{"jobs":[\n{"job_id":%d,"settings":{"name":"x"}},{"job_id":7,"settings":{"name":"twice"}}]}' % i)
    pages = json_pages(spark, str(tmp_path))
    assert rows(acl.listing(pages.where("kind = 'Jobs'"), "Jobs").select("id")) == [("0",), ("1",), ("7",)]


def test_broken_acl_documents_fail(spark):
    for doc in ('{"access_control_list":[{"group_name":"g"', "<html>", '{"access_control_list":"x"}'):
        with pytest.raises(Exception):
            acl.parse_acl(spark.createDataFrame([(doc,)], "doc string")).collect()


def test_models_without_an_id_stay(spark):
    pages = spark.createDataFrame([('{"registered_models":[{"name":"m"},{"name":"n"}]}',)], "page string")
    ids = spark.createDataFrame([("m", 77), ("m", 77)], "name string, model_id int")
    assert rows(acl.listing(pages, "MLFlow_Models", ids)) == [("MLFlow_Model", "m", "77"), ("MLFlow_Model", "n", None)]


def test_the_last_answer_counts(spark):
    keys = ("Job", "1", "g", "CAN_VIEW")
    answers = spark.createDataFrame(
        [(*keys, 429, "slow", 1), (*keys, 200, "", 2), ("Job", "2", "g", "CAN_VIEW", 200, "", 1), ("Job", "2", "g", "CAN_VIEW", 403, "no", 2)],
        "artifact_type string, id string, new_group_names string, permission_level string, status_code int, content string, answered_at int",
    )
    stored = spark.createDataFrame(
        [("n", i, "g", "g", "CAN_VIEW", None, "Job") for i in "12"], schemas.PERMISSIONS
    )
    found = {r.id: r.permission_update_status for r in acl.permission_status(stored, answers).collect()}
    assert found == {"1": "Permission set Successfully", "2": "Error: no"}


def test_writers_of_different_types_do_not_meet(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    types = [k.label for k in acl.KINDS.values()][:6]
    frames = {
        t: spark.createDataFrame([(f"n{i}", str(i), "g", "g", "A", None, t) for i in range(5)], schemas.PERMISSIONS)
        for t in types
    }
    write_permissions(frames[types[0]], "permissions_threads", str(tmp_path / "threads"))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda t: write_permissions(frames[t], "permissions_threads"), types * 2))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    spark.catalog.recoverPartitions("permissions_threads")
    spark.catalog.refreshTable("permissions_threads")
    counts = spark.table("permissions_threads").groupBy("artifact_type").count().collect()
    assert {r.artifact_type: r["count"] for r in counts} == dict.fromkeys(types, 5)


def test_a_failed_write_leaves_the_partitions(spark, tmp_path):
    table, place = "permissions_failing", tmp_path / "failing"
    write_permissions(permission_rows(spark), table, str(place))
    broken = permission_rows(spark).withColumn("name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        write_permissions(broken, table)
    assert rows(spark.table(table)) == rows(permission_rows(spark))
    assert not list((place / "_versions").glob("*"))


def test_an_update_writes_each_row_once(spark, tmp_path):
    table, place = "permissions_once", tmp_path / "once"
    write_permissions(permission_rows(spark), table, str(place))
    untouched = {p.name for p in (place / "artifact_type=Repo").iterdir()}
    for _ in range(2):
        update_permissions(spark, table, responses(spark))
        # old versions are gone, the new one holds the answered types only
        kept = sorted(p.name for p in (place / "_versions").glob("*/*") if p.is_dir())
        assert kept == ["artifact_type=Job", "artifact_type=Secret"]
    assert not (place / "artifact_type=Job").exists()
    assert {p.name for p in (place / "artifact_type=Repo").iterdir()} == untouched
    assert spark.table(table).count() == permission_rows(spark).count()


def answers_and_rows(spark):
    """Stored rows of four types, one without answers; keys repeat or are null, some stay without an answer."""
    sizes = {"Job": 300, "Pool": 40, "Repo": 50, "Cluster": 30}
    stored = [
        (f"n{i}", None if i % 10 == 9 else str(i // 2), "g", "g", "AB"[i % 3 == 0], "old" if i % 4 == 0 else None, t)
        for t, n in sizes.items() for i in range(n)
    ]
    answers = [
        (t, None if i % 10 == 9 else str(i // 2), "g", "AB"[i % 3 == 0], 200 if i % 5 else 403, f"no {i}", i)
        for t, n in sizes.items() if t != "Repo" for i in range(0, n, 2 if t == "Pool" else 1)
    ]
    schema = "artifact_type string, id string, new_group_names string, permission_level string, status_code int, content string, answered_at int"
    return spark.createDataFrame(stored, schemas.PERMISSIONS), spark.createDataFrame([*answers, ("Other", "1", "g", "A", 200, "", 1), (None, "1", "g", "A", 200, "", 1)], schema)


@pytest.mark.parametrize("id_type,largest,number", [("string", 170, 6), ("bigint", 600, 2)])
def test_a_large_update_goes_in_rounds(spark, tmp_path, monkeypatch, id_type, largest, number):
    """A type above the bound is updated by parts of its keys, unless those are of another data type."""
    table, seen = f"permissions_rounds_{id_type}", []
    stored, answers = answers_and_rows(spark)
    answers = answers.withColumn("id", F.col("id").cast(id_type))

    def spy(some, some_answers):
        seen.append((some.count(), some_answers.count()))
        return acl.permission_status(some, some_answers)

    write_permissions(stored, table, str(tmp_path / "rounds"))
    monkeypatch.setattr(sinks.tables, "ROWS_A_ROUND", 120)
    monkeypatch.setattr(sinks.tables, "permission_status", spy)
    update_permissions(spark, table, answers)
    assert len(seen) == number and max(map(sum, seen)) <= largest
    assert tuple(map(sum, zip(*seen))) == (370, 350)
    assert rows(spark.table(table)) == rows(acl.permission_status(stored, answers))
    assert len(list((tmp_path / "rounds" / "_versions").iterdir())) == 1


def test_a_failed_round_leaves_the_partitions(spark, tmp_path, monkeypatch):
    table, place = "permissions_round_failing", tmp_path / "failing"
    stored, answers = answers_and_rows(spark)
    write_permissions(stored, table, str(place))
    monkeypatch.setattr(sinks.tables, "ROWS_A_ROUND", 70)
    broken = answers.withColumn("content", F.when(F.col("artifact_type") == "Job", F.raise_error(F.lit("broken"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="broken"):
        update_permissions(spark, table, broken)
    assert rows(spark.table(table)) == rows(stored)
    assert not list((place / "_versions").glob("*"))


def test_an_update_without_answers_changes_nothing(spark, tmp_path):
    stored, answers = answers_and_rows(spark)
    write_permissions(stored, "permissions_unanswered", str(tmp_path / "unanswered"))
    update_permissions(spark, "permissions_unanswered", answers.where("artifact_type = 'Other' or artifact_type is null"))
    assert rows(spark.table("permissions_unanswered")) == rows(stored)
    assert not (tmp_path / "unanswered" / "_versions").exists()


def test_permission_writes_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {n for n in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in n}

    def gone():
        until = time.time() + 10
        while not shuffles() <= before and time.time() < until:
            time.sleep(0.2)
        return shuffles() <= before

    def spy(some, some_answers):
        assert gone()
        return acl.permission_status(some, some_answers)

    table, before, setting = "permissions_shuffles", shuffles(), spark.conf.get(CLEANUP, None)
    stored, answers = answers_and_rows(spark)
    write_permissions(stored, table, str(tmp_path / "shuffles"))
    assert gone()
    monkeypatch.setattr(sinks.tables, "permission_status", spy)
    update_permissions(spark, table, answers)
    assert gone() and spark.conf.get(CLEANUP, None) == setting


def test_broken_documents_are_set_apart(spark, tmp_path):
    good = '{"access_control_list":[{"group_name":"g","all_permissions":[{"permission_level":"A"}]}]}'
    broken = ["{", "", "no", '[{"group_name":"g"}]', '{"access_control_list":7}', good + " {"]
    rows = [(1, good, "x"), (2, "{}", "x"), (3, "null", "x"), (4, None, "x"), *((9, b, "y") for b in broken)]
    df = spark.createDataFrame(rows, "k int, doc string, parsed string")
    out = acl.parse_acl(df, rejects=True)
    sinks.write_checked(out, str(tmp_path / "acls"))
    kept = sources.accepted(spark, str(tmp_path / "acls"), out.schema)
    lost = sources.rejected(spark, str(tmp_path / "acls"), out.schema)
    found = {r.k: r for r in kept.collect()}
    assert set(found) == {1, 2, 3, 4} and kept.columns == ["k", "parsed", "perms"]
    assert found[1].perms[0].group_name == "g" and all(found[k].perms == [None] for k in (2, 3, 4))
    assert sorted(r.rejected for r in lost.collect()) == sorted(broken)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        acl.parse_acl(df).collect()


def test_accepted_and_rejected_of_empty_and_clean_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "{}")], "k int, doc string")
    for name, rows in (("empty", df.limit(0)), ("clean", df)):
        out = acl.parse_acl(rows, rejects=True)
        sinks.write_checked(out, str(tmp_path / name))
        assert sources.rejected(spark, str(tmp_path / name), out.schema).count() == 0
        assert sources.accepted(spark, str(tmp_path / name), out.schema).count() == rows.count()


def test_reject_tables_are_pruned_and_parsed_once(spark, tmp_path):
    df = spark.range(20).select("id", F.when(F.col("id") % 2 == 0, "{}").otherwise("{").alias("doc"))
    out = acl.parse_acl(df, rejects=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("JsonToStructs") <= 1
    sinks.write_checked(out, str(tmp_path / "t"))
    plan = sources.rejected(spark, str(tmp_path / "t"), out.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_rejected" in plan
