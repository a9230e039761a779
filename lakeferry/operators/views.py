"""View migration: definitions, rewritten SQL, statements and status."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions import (
    grouped_lookup,
    last_answer,
    lookup,
    quote,
    quote_if_needed,
    quoted_literal,
    sql_text,
)
from lakeferry.operators.inventory import with_database_column
from lakeferry.operators.sync import NO_OUTCOME, marker_status, numbered_statements, with_target
from lakeferry.session import staged

# The legacy catalog, the schema every catalog owns, the label of a view's text.
LEGACY_CATALOG = "hive_metastore"
INFORMATION_SCHEMA = "information_schema"
VIEW_TEXT = "View Text"
CREATED = "VIEW CREATED SUCCESSFULLY"
NO_VIEWS = "No Views Found"
NO_OUTCOME_TEXT = "no outcome"
CYCLE = "reads itself through other views, or a view that does"

_IDENTIFIER = r"(?:`[^`]+`|`?\w+`?)"
_LEGACY = rf"`?{LEGACY_CATALOG}`?\."
# SQL that names nothing: literals of both quotes (raw ones have no escapes) and comments. An open one
# goes on to the end of the text.
_SILENT = (
    r"(?<!\w)[rR](?:'[^']*+(?:'|\z)|\"[^\"]*+(?:\"|\z))"
    r"|'[^'\\]*+(?:\\.[^'\\]*+)*+(?:'|\\?\z)|\"[^\"\\]*+(?:\\.[^\"\\]*+)*+(?:\"|\\?\z)"
    r"|--[^\n]*+|/\*.*?(?:\*/|\z)"
)
_MARK = "\0"


def view_definitions(describe_rows: DataFrame) -> DataFrame:
    """(database, viewName, view_text) from description rows; the first text of a view wins."""
    rows = with_database_column(describe_rows).where(F.col("col_name") == VIEW_TEXT)
    return rows.groupBy("database", F.col("tableName").alias("viewName")).agg(
        F.min_by("data_type", "ordinal").alias("view_text")
    )


def upgraded_schemas(tables_index: DataFrame) -> DataFrame:
    """Schemas that already exist outside the legacy catalog."""
    return (
        tables_index.where(
            (F.col("table_catalog") != LEGACY_CATALOG)
            & (F.col("table_schema") != INFORMATION_SCHEMA)
        )
        .select("table_schema")
        .distinct()
    )


def _rewrite_pieces(
    views: DataFrame, pieces: Column, name: Column, targets: DataFrame, replacement: Column
) -> DataFrame:
    """Cut each text into pieces that start at a candidate name, look the names up with one
    equi-join and put the pieces of a text back in order.

    A piece without a name gets one that no schema has, spread over many, so that the join meets no
    common empty key. A row that repeats a text counts once, different texts of one view stay apart,
    and a null text stays null.
    """
    keys = ["database", "viewName", "_text"]
    nameless = F.concat(F.lit("\0"), F.pmod(F.hash("_text", "at"), F.lit(4096)).cast("string"))
    put = (
        views.withColumn("_text", F.xxhash64("view_text"))
        .select("*", F.posexplode_outer(pieces).alias("at", "piece"))
        .withColumn("name", F.coalesce(F.nullif(name, F.lit("")), nameless, F.lit("\0")))
        .join(targets, "name", "left")
        .select(*keys, "at", replacement.alias("piece"))
    )
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return (
        put.groupBy(*keys)
        .agg(F.array_sort(F.collect_set(F.struct("at", "piece"))).alias("pieces"))
        .select(
            "database",
            "viewName",
            F.when(F.get("pieces", F.lit(0))["at"].isNotNull(), text).alias("view_text"),
        )
    )


def _schema_targets(databases: DataFrame | None) -> DataFrame | None:
    return None if databases is None else with_target(databases)


def _bare(identifier: Column) -> Column:
    return F.replace(identifier, F.lit("`"), F.lit(""))


def _pieces(text: Column, name: str, place: str, written: str = "") -> Column:
    """Pieces of a text that start at the names of its code.

    ``name`` is the pattern of a name, ``place`` what must hold before it. The text is cut into
    literals, comments, names, words and single characters; of the names ``written`` is left out, and
    also where it stands without one. A text with a NUL character is one piece.
    """
    lone = rf"(?<![\w`.]){written}|" if written else ""
    token = rf"(?s){_SILENT}|{place}{name}|{lone}`[^`]*+`|\w++|\s++|."
    tokens = F.regexp_extract_all(text, F.lit(token), F.lit(0))

    def kept(t: Column) -> Column:
        shown = F.when(t.rlike(f"^{name}$"), F.concat(F.lit(_MARK), F.regexp_replace(t, f"^{written}", "")))
        return (shown.when(t.rlike(f"^{written}$"), F.lit("")) if written else shown).otherwise(t)

    cut = F.split(F.array_join(F.transform(tokens, kept), ""), f"(?={_MARK})")
    return F.when(F.contains(text, F.lit(_MARK)), F.array(text)).otherwise(cut)


def rewrite_views(
    views: DataFrame,
    schemas: DataFrame,
    catalog: str,
    boundaries: str = "all",
    databases: DataFrame | None = None,
) -> DataFrame:
    """Drop the legacy catalog from view SQL, then prefix upgraded schemas with ``catalog``.

    ``views`` holds (database, viewName, view_text); ``schemas`` the column ``table_schema``;
    ``databases`` may name a ``target_database`` that an upgraded schema is called by from then on. A
    schema counts where it follows a blank, ``(`` or ``,`` or opens the text; ``boundaries="blank"``
    accepts a single space only. Literals and comments stay as they are.
    """
    place = r"(?:^|(?<=[\s(,]))" if boundaries == "all" else "(?<= )"
    name = rf"(?:{_LEGACY})?+{_IDENTIFIER}\."
    opening = F.regexp_extract("piece", rf"^{_MARK}({_IDENTIFIER})\.", 1)
    upgraded = lookup(schemas.select(F.col("table_schema").alias("name")), "name")
    targets = _schema_targets(databases)
    if targets is None:
        hit = upgraded.withColumn("target", F.col("name"))
    else:
        renamed = targets.select(F.col("database").alias("name"), "target_schema")
        hit = upgraded.join(renamed, "name", "left").select(
            "name", F.coalesce("target_schema", "name").alias("target")
        )
    prefixed = F.concat(
        quote_if_needed(F.lit(catalog)),
        F.lit("."),
        quote_if_needed(F.col("target")),
        F.substr(F.col("piece"), F.length(opening) + 2),
    )
    return _rewrite_pieces(
        views.select("database", "viewName", "view_text"),
        _pieces(F.col("view_text"), name, place, _LEGACY),
        _bare(opening),
        hit,
        F.when(F.col("target").isNotNull(), prefixed).otherwise(_unmarked(F.col("piece"))),
    )


def _unmarked(piece: Column) -> Column:
    """A piece that starts at a name without its mark; others have none."""
    return F.regexp_replace(piece, rf"^{_MARK}(?={_IDENTIFIER})", "")


def rewrite_views_mapped(
    views: DataFrame, mapping: DataFrame, catalog: str, databases: DataFrame | None = None
) -> DataFrame:
    """Replace ``hive_metastore.src`` by the quoted target of ``mapping`` (src, dst).

    A view's own database becomes its ``target_database`` in ``databases``, or keeps its name,
    whatever the mapping says. Literals and comments stay as they are.
    """
    own_targets = _schema_targets(databases)
    if own_targets is None:
        placed = views.select("database", "viewName", "view_text", F.col("database").alias("_own"))
    else:
        placed = views.join(own_targets, "database", "left").select(
            "database", "viewName", "view_text", F.coalesce("target_schema", "database").alias("_own")
        )
    named = rf"{_LEGACY}{_IDENTIFIER}"
    opening = F.regexp_extract("piece", rf"^{_MARK}({named})", 1)
    name = _bare(F.regexp_extract("piece", rf"^{_MARK}{_LEGACY}({_IDENTIFIER})", 1))
    targets = grouped_lookup(
        mapping.withColumnRenamed("src", "name"), ["name"], F.min("dst").alias("dst")
    )
    own = F.when(F.col("name") == F.col("database"), F.col("_own"))
    target = F.coalesce(own, F.col("dst"))
    replaced = F.concat(
        F.lit(f"{quoted_literal(catalog)}."),
        quote(target),
        F.substr(F.col("piece"), F.length(opening) + 2),
    )
    return _rewrite_pieces(
        placed,
        _pieces(F.col("view_text"), named, r"(?<![\w`.])"),
        name,
        targets,
        F.when(target.isNotNull(), replaced).otherwise(_unmarked(F.col("piece"))),
    )


def view_dependencies(views: DataFrame) -> DataFrame:
    """(database, viewName, needs_database, needs_view): which views a view reads.

    Qualified names count wherever they stand in the code, the last two parts of them; bare names, of
    the view's own database, after FROM and JOIN only. Literals and comments name nothing. Only names of
    views in ``views`` are kept, so aliases and columns rarely pass.
    """
    code = F.regexp_replace("view_text", f"(?s){_SILENT}", " ")
    part = r"(?:`[^`]+`|\w+)"
    item = rf"{part}(?:\.{part})*+(?:(?:\s+[aA][sS])?\s+\w+)?+"
    qualified = F.regexp_extract_all(code, F.lit(rf"(?<![\w`.]){part}(?:\.{part})++"), F.lit(0))
    clauses = F.regexp_extract_all(code, F.lit(rf"(?i)\b(?:FROM|JOIN)\s+({item}(?:\s*,\s*{item})*+)"), F.lit(1))
    listed = F.flatten(F.transform(clauses, lambda c: F.split(c, r"\s*,\s*")))
    bare = F.filter(
        F.transform(listed, lambda c: F.regexp_extract(c, rf"^({part})(?![\w`.])", 1)), lambda c: c != ""
    )
    names = views.select("database", "viewName", F.explode(F.array_distinct(F.concat(qualified, bare))).alias("_name"))
    parts = F.transform(F.regexp_extract_all("_name", F.lit(part), F.lit(0)), _bare)
    found = names.select(
        "database",
        "viewName",
        F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise(F.col("database")).alias("needs_database"),
        F.element_at(parts, -1).alias("needs_view"),
    )
    known = lookup(views.select(F.col("database").alias("needs_database"), F.col("viewName").alias("needs_view")),
                   "needs_database", "needs_view")
    return lookup(
        found.join(known, ["needs_database", "needs_view"], "left_semi"),
        "database", "viewName", "needs_database", "needs_view",
    )


def view_order(views: DataFrame) -> DataFrame:
    """(database, viewName, level, message): a view can be created when all of lower levels are there.

    Level 0 reads no other view. Each round marks the edges to the views of the level before and gives the
    next level to the views that have no other; open edges get fewer each time. Views that are left when a
    round finds none are in a cycle or read one: they have a message and no level.
    """
    keys, needs = ["database", "viewName"], ["needs_database", "needs_view"]
    edges = staged(view_dependencies(views), "view-edges")
    listed = views.select(*keys, F.lit(False).alias("_needs")).union(edges.select(*keys, F.lit(True)))
    met = listed.groupBy(*keys).agg(F.bool_or("_needs").alias("_needs")).where("NOT _needs").select(*keys)
    leveled = [met.select(*keys, F.lit(0).alias("level"), F.lit("").alias("message"))]
    level = 0
    while not edges.isEmpty():
        level += 1
        done = met.select(
            F.col("database").alias("needs_database"), F.col("viewName").alias("needs_view"), F.lit(True).alias("_done")
        )
        marked = staged(edges.join(done, needs, "left"), "view-edges")
        edges = marked.where("_done IS NULL").drop("_done")
        all_done = marked.groupBy(*keys).agg((F.count("*") == F.count("_done")).alias("_all"))
        met = staged(all_done.where("_all").select(*keys), "view-level")
        if met.isEmpty():
            break
        leveled.append(met.select(*keys, F.lit(level).alias("level"), F.lit("").alias("message")))
    stuck = edges.select(*keys).distinct().select(
        *keys, F.lit(None).cast("int").alias("level"), F.lit(CYCLE).alias("message")
    )
    return reduce(DataFrame.unionByName, [*leveled, stuck])


def ordered_view_statements(rewritten: DataFrame, order: DataFrame, catalog: str, **options) -> DataFrame:
    """``view_statements`` with ``level`` and ``message`` of ``order``, to be run level by level.

    A view without a level has one row with its message and no statement. Texts meet their view's level in
    one shuffle by view; a join would send them to the driver where their files are small.
    """
    keys = ["database", "viewName"]
    text = F.struct("view_text")
    levels = order.select(*keys, "level", "message", F.lit(None).cast("struct<view_text:string>").alias("_text"))
    texts = rewritten.select(*keys, F.lit(None).cast("int"), F.lit(None).cast("string"), text)
    met = (
        levels.union(texts)
        .groupBy(*keys)
        .agg(F.max("level").alias("level"), F.max("message").alias("message"), F.collect_list("_text").alias("_texts"))
        .where("level IS NOT NULL")
        .select(*keys, "level", "message", F.inline("_texts"))
    )
    statements = view_statements(met, catalog, kept=("level", "message"), **options)
    cannot = order.where(F.col("level").isNull()).select(
        *keys, "level", F.lit(None).cast("int").alias("step"), F.lit(None).cast("string").alias("statement"), "message"
    )
    return statements.select(*keys, "level", "step", "statement", "message").unionByName(cannot)


def view_statements(
    rewritten: DataFrame,
    catalog: str,
    owner: str | None = None,
    privilege: str | None = None,
    principal: str | None = None,
    databases: DataFrame | None = None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Create, owner and grant statements per rewritten view, the last two only when asked for.

    A view is created in the ``target_database`` of its database, as ``view_status`` reports it. A
    view without text gets no create statement. Columns ``kept`` stay with the statements.
    """
    schema = F.col("database")
    targets = _schema_targets(databases)
    if targets is not None:
        rewritten = rewritten.join(targets, "database", "left")
        schema = F.coalesce("target_schema", "database")
    view = sql_text(f"{quoted_literal(catalog)}.", quote(schema), ".", quote(F.col("viewName")))
    no_statement = F.lit(None).cast("string")
    readable = privilege is not None and ("SELECT" in privilege or "ALL PRIVILEGES" in privilege)
    return numbered_statements(
        rewritten,
        ["database", "viewName", *kept],
        [
            sql_text("CREATE OR REPLACE VIEW ", view, " AS ", F.col("view_text")),
            sql_text("ALTER VIEW ", view, f" OWNER TO {quoted_literal(owner)}")
            if owner is not None
            else no_statement,
            sql_text("GRANT SELECT ON VIEW ", view, f" TO {quoted_literal(principal)}")
            if readable and principal is not None
            else no_statement,
        ],
    )


def view_status(
    databases: DataFrame, views: DataFrame, outcomes: DataFrame, catalog: str
) -> DataFrame:
    """Status row per view; the last of its outcomes (database, viewName, message, answered_at)
    decides: no message is success, no outcome row is ``NO_OUTCOME``."""
    databases = with_target(databases)
    keys = ["database", "viewName"]
    last = last_answer(outcomes, keys, "message")
    message = F.col("answer.message")
    rows = (
        lookup(views, *keys)
        .join(databases, "database")
        .join(last, keys, "left")
        .select(
            F.col("database").alias("source_schema"),
            F.col("viewName").alias("source_name"),
            F.lit("VIEW").alias("source_type"),
            F.lit(catalog).alias("target_catalog"),
            "target_schema",
            F.col("viewName").alias("target_name"),
            F.when(F.col("answer").isNull(), NO_OUTCOME)
            .when(message.isNull(), "SUCCESS")
            .otherwise("Error")
            .alias("status_code"),
            F.when(F.col("answer").isNull(), NO_OUTCOME_TEXT)
            .otherwise(F.coalesce(message, F.lit(CREATED)))
            .alias("description"),
        )
    )
    return rows.unionByName(marker_status(databases, views, catalog, NO_VIEWS))
