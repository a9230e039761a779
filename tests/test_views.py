import pytest

from lakeferry import schemas
from lakeferry.operators import views
from lakeferry.operators.sync import with_target

SCHEMA = "database string, viewName string, view_text string"


def rewrite(spark, text, names=("db", "x-y", "cat"), catalog="cat", **options):
    df = spark.createDataFrame([("own", "v", text)], SCHEMA)
    upgraded = spark.createDataFrame([(n,) for n in names], "table_schema string")
    return views.rewrite_views(df, upgraded, catalog, **options).first()["view_text"]


def test_legacy_catalog_goes_and_upgraded_schemas_get_the_catalog(spark):
    text = "SELECT * FROM `hive_metastore`.`db`.`t` JOIN hive_metastore.db.u JOIN other.t"
    assert rewrite(spark, text) == "SELECT * FROM cat.db.`t` JOIN cat.db.u JOIN other.t"


def test_boundaries(spark):
    text = "SELECT f(db.a),db.b FROM (db.t)\nJOIN\tdb.u ON xdb.c = db.d AND a.db.e = 1"
    assert rewrite(spark, text) == (
        "SELECT f(cat.db.a),cat.db.b FROM (cat.db.t)\nJOIN\tcat.db.u ON xdb.c = cat.db.d AND a.db.e = 1"
    )
    assert rewrite(spark, "FROM (db.t) JOIN db.u,db.w", boundaries="blank") == (
        "FROM (db.t) JOIN cat.db.u,db.w"
    )
    assert rewrite(spark, "db.t") == "cat.db.t"
    assert rewrite(spark, "db.t", boundaries="blank") == "db.t"


def test_no_double_prefix_when_the_catalog_is_a_schema_name(spark):
    assert rewrite(spark, "FROM db.t JOIN cat.u") == "FROM cat.db.t JOIN cat.cat.u"


def test_odd_names_keep_their_quotes(spark):
    assert rewrite(spark, "FROM `x-y`.t", catalog="my-cat") == "FROM `my-cat`.`x-y`.t"
    assert rewrite(spark, "FROM db.t", catalog="a$1") == "FROM `a$1`.db.t"


def test_dot_after_the_legacy_catalog_is_a_dot(spark):
    assert rewrite(spark, "SELECT hive_metastore_x FROM db.t") == "SELECT hive_metastore_x FROM cat.db.t"


def test_views_stay_whole_and_apart(spark):
    rows = [("d", f"v{n}", " ".join(f"db.t{i}" for i in range(n))) for n in range(1, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    upgraded = spark.createDataFrame([("db",), ("db",)], "table_schema string")
    out = {r.viewName: r.view_text for r in views.rewrite_views(df, upgraded, "cat").collect()}
    assert out == {v: t.replace("db.", "cat.db.") for _, v, t in rows}


def test_mapped_rewrite(spark):
    df = spark.createDataFrame(
        [("own", "v", "FROM hive_metastore.own.a, `hive_metastore`.`src`.b, hive_metastore.src2.c, src.d")],
        SCHEMA,
    )
    mapping = spark.createDataFrame([("src", "dst"), ("own", "ignored")], "src string, dst string")
    assert views.rewrite_views_mapped(df, mapping, "cat").first()["view_text"] == (
        "FROM `cat`.`own`.a, `cat`.`dst`.b, hive_metastore.src2.c, src.d"
    )


def test_upgraded_schemas(spark):
    index = spark.createDataFrame(
        [("cat", "a"), ("cat", "a"), ("hive_metastore", "b"), ("cat", "information_schema"), (None, "c")],
        "table_catalog string, table_schema string",
    )
    assert [r[0] for r in views.upgraded_schemas(index).collect()] == ["a"]


def test_definitions_take_the_first_text(spark):
    rows = [("d", "v", 9, "View Text", "second"), ("d", "v", 3, "View Text", "first"), ("d", "t", 1, "Type", "x")]
    df = spark.createDataFrame(
        rows, "database string, tableName string, ordinal int, col_name string, data_type string"
    )
    assert [tuple(r) for r in views.view_definitions(df).collect()] == [("d", "v", "first")]


def test_statements_optional_parts(spark):
    df = spark.createDataFrame([("d", "v", "SELECT 1")], SCHEMA)

    def statements(*args):
        return [r.statement for r in views.view_statements(df, "cat", *args).orderBy("step").collect()]

    create = "CREATE OR REPLACE VIEW `cat`.`d`.`v` AS SELECT 1"
    grant = "GRANT SELECT ON VIEW `cat`.`d`.`v` TO `p`"
    assert statements() == [create]
    assert statements("o") == [create, "ALTER VIEW `cat`.`d`.`v` OWNER TO `o`"]
    assert statements(None, "ALL PRIVILEGES", "p") == [create, grant]
    assert statements(None, "MODIFY", "p") == [create]


def test_status(spark):
    databases = spark.createDataFrame([("d",), ("e",)], "database string")
    df = spark.createDataFrame([("d", "v", "x"), ("d", "w", "x"), ("d", "x", "x")], SCHEMA)
    outcomes = spark.createDataFrame(
        [("d", "v", None), ("d", "w", "boom")], "database string, viewName string, message string"
    )
    out = views.view_status(databases, df, outcomes, "cat")
    assert out.columns == schemas.STATUS.names
    assert {(r.source_schema, r.source_name, r.source_type, r.status_code, r.description) for r in out.collect()} == {
        ("d", "v", "VIEW", "SUCCESS", "VIEW CREATED SUCCESSFULLY"),
        ("d", "w", "VIEW", "Error", "boom"),
        ("d", "x", "VIEW", "NO_OUTCOME", "no outcome"),
        ("e", "", "", "SUCCESS", "No Views Found"),
    }


def test_null_and_repeated_views_stay_whole(spark):
    rows = [("d", "v", "FROM db.t JOIN db.u")] * 2 + [("d", "n", None), ("d", "v", "FROM my_hive_metastore.q, db.x")]
    upgraded = spark.createDataFrame([("db",)], "table_schema string")
    out = views.rewrite_views(spark.createDataFrame(rows, SCHEMA), upgraded, "cat").collect()
    assert sorted((r.viewName, r.view_text or "") for r in out) == [
        ("n", ""),
        ("v", "FROM cat.db.t JOIN cat.db.u"),
        ("v", "FROM my_hive_metastore.q, cat.db.x"),
    ]


def test_target_database_in_text_statement_and_status(spark):
    databases = spark.createDataFrame([("d", "d2")], "database string, target_database string")
    df = spark.createDataFrame([("d", "v", "FROM hive_metastore.d.t")], SCHEMA)
    upgraded = spark.createDataFrame([("d",)], "table_schema string")
    mapping = spark.createDataFrame([("x", "y")], "src string, dst string")
    rewritten = views.rewrite_views(df, upgraded, "cat", databases=databases)
    assert rewritten.first()["view_text"] == "FROM cat.d2.t"
    assert views.rewrite_views_mapped(df, mapping, "cat", databases).first()["view_text"] == "FROM `cat`.`d2`.t"
    created = views.view_statements(rewritten, "cat", databases=databases).first()["statement"]
    assert created == "CREATE OR REPLACE VIEW `cat`.`d2`.`v` AS FROM cat.d2.t"
    outcomes = spark.createDataFrame([("d", "v", None)], "database string, viewName string, message string")
    assert views.view_status(databases, df, outcomes, "cat").first()["target_schema"] == "d2"


def test_literals_and_comments_stay(spark):
    text = (
        "SELECT 'see db.a', \"db.b\", r'\\', db.c, 'it\\'s db.d', 'x''db.e' -- from db.t don't\n"
        "FROM hive_metastore.db.t /* db.u\n'*/ JOIN db.u WHERE a = 'hive_metastore.db.x' AND b = ' db.open"
    )
    assert rewrite(spark, text) == (
        "SELECT 'see db.a', \"db.b\", r'\\', cat.db.c, 'it\\'s db.d', 'x''db.e' -- from db.t don't\n"
        "FROM cat.db.t /* db.u\n'*/ JOIN cat.db.u WHERE a = 'hive_metastore.db.x' AND b = ' db.open"
    )
    df = spark.createDataFrame([("own", "v", "FROM hive_metastore.db.t -- hive_metastore.db.u\nWHERE a='hive_metastore.db.x'")], SCHEMA)
    mapping = spark.createDataFrame([("db", "dst")], "src string, dst string")
    assert views.rewrite_views_mapped(df, mapping, "cat").first()["view_text"] == (
        "FROM `cat`.`dst`.t -- hive_metastore.db.u\nWHERE a='hive_metastore.db.x'"
    )


def test_very_long_texts(spark):
    text = "SELECT '" + "long db.x " * 50_000 + "' FROM db.t WHERE " + " OR ".join(f"a = {i}" for i in range(20_000))
    assert rewrite(spark, text) == text.replace("FROM db.t", "FROM cat.db.t")


def test_legacy_name_without_a_schema_and_marks_in_texts(spark):
    assert rewrite(spark, "FROM hive_metastore.t, x=hive_metastore.db.u") == "FROM t, x=db.u"
    assert rewrite(spark, "FROM db.t \0 db.u") == "FROM db.t \0 db.u"


def test_several_targets_of_a_database_fail(spark):
    databases = spark.createDataFrame([("a", "x"), ("a", "y")], "database string, target_database string")
    df = spark.createDataFrame([("v", "v", "SELECT * FROM a.t WHERE note = 1")], SCHEMA)
    upgraded = spark.createDataFrame([("a",)], "table_schema string")
    with pytest.raises(Exception, match="several targets"):
        views.rewrite_views(df, upgraded, "cat", databases=databases).collect()
    once = databases.unionByName(spark.createDataFrame([("b", None), ("b", "z"), ("b", "z")], databases.schema))
    targets = {r.database: r.target_schema for r in with_target(once.where("database = 'b'")).collect()}
    assert targets == {"b": "z"}


def test_order_of_views(spark):
    rows = [
        ("d", "a", "SELECT 1"),
        ("d", "b", "SELECT * FROM a x, e.c AS y JOIN `d`.`a`"),
        ("e", "c", "SELECT cat.d.a.k FROM cat.d.a -- JOIN d.b"),
        ("e", "top", "SELECT 'd.loop' FROM (SELECT * FROM d.b) JOIN c"),
        ("d", "loop", "FROM d.pool"),
        ("d", "pool", "FROM loop"),
        ("d", "after", "FROM pool JOIN a"),
        ("d", "self", "FROM self"),
        ("d", "null", None),
        ("d", "a", "SELECT 1"),
    ]
    found = {(r.database, r.viewName): r.level for r in views.view_order(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {
        ("d", "a"): 0, ("d", "null"): 0, ("e", "c"): 1, ("d", "b"): 2, ("e", "top"): 3,
        ("d", "loop"): None, ("d", "pool"): None, ("d", "after"): None, ("d", "self"): None,
    }
    assert views.view_order(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ordered_statements_send_no_view_to_the_driver(spark):
    named = spark.createDataFrame([("d", "a", "SELECT 1"), ("d", "b", "FROM a"), ("d", "c", "FROM c")], SCHEMA)
    order = views.view_order(named)
    out = views.ordered_view_statements(named, order, "cat")
    assert sorted((r.viewName, r.level, r.step, r.message) for r in out.where("step = 1").collect()) == [
        ("a", 0, 1, ""), ("b", 1, 1, "")
    ]
    assert [(r.viewName, r.message) for r in out.where("step IS NULL").collect()] == [("c", views.CYCLE)]
    for df in (order, out):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
