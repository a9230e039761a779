"""Storage roots of external tables, their external locations and a job account's grants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions import (
    contained_texts,
    containing_texts,
    contains_pairs,
    information_value,
    lookup,
    path_prefixes,
    quote,
    quoted_literal,
    sql_text,
)
from lakeferry.operators.inventory import with_database_column
from lakeferry.session import staged

# Privileges a job account needs on source and target schemas, in order.
SOURCE_PRIVILEGES = ("USE_SCHEMA", "SELECT")
TARGET_PRIVILEGES = ("USE_SCHEMA", "SELECT", "CREATE TABLE", "MODIFY")

#: Rows that one part of a location match gives, and the most tasks that its parts are dealt to.
PART_ROWS = 4_000_000
MOST_TASKS = 2000


def external_table_roots(tables: DataFrame, literal: bool = True, trim: bool = True) -> DataFrame:
    """Distinct parent locations of external tables.

    The last path segment goes when it equals the table name. ``literal=False`` takes the table
    name as a regular expression and removes every occurrence.
    """
    info = F.col("information")
    location = information_value(info, "Location", trim)
    if literal:
        ends = F.endswith(location, F.concat(F.lit("/"), F.col("tableName")))
        size = F.length(location) - F.length("tableName")
        root: Column = F.when(ends, F.substr(location, F.lit(1), size)).otherwise(location)
    else:
        root = F.regexp_replace(location, F.col("tableName"), F.lit(""))
    return (
        with_database_column(tables)
        .where(information_value(info, "Type", trim).like("%EXTERNAL%"))
        .select(root.alias("Location"))
        .dropDuplicates(["Location"])
    )


def match_locations(roots: DataFrame, ext_locations: DataFrame, prefix: bool = False) -> DataFrame:
    """(Location, name, url) for each root and external location of which one contains the other.

    ``prefix=True`` is stricter: one must be an ancestor folder of the other, or the same.
    Both ways are equi-joins on derived keys, so neither side has to fit into memory. Pairs are found
    between different paths; the names of a url, of which there may be many, are put to them last.
    """
    named = ext_locations.select("name", "url")
    # roots are cut out of long texts, and every way below reads them more than once
    roots = staged(lookup(roots, "Location"), "location-roots")
    if prefix:
        root_ids = roots.withColumn("folder", F.rtrim("Location", F.lit("/")))
        url_ids = lookup(named, "url").withColumn("folder", F.rtrim("url", F.lit("/")))
        below = root_ids.select("Location", F.explode(path_prefixes(F.col("Location"))).alias("folder"))
        above = url_ids.select("url", F.explode(path_prefixes(F.col("url"))).alias("folder"))
        pairs = below.join(url_ids, "folder").unionByName(above.join(root_ids, "folder"))
        return _with_names(pairs.select("Location", "url").distinct(), named.distinct())
    locations = roots.select(F.col("Location").alias("text"))
    urls = named.select(F.col("url").alias("text"))
    inside = contains_pairs(locations, urls).select(
        F.col("longer").alias("Location"), F.col("shorter").alias("url")
    )
    around = contains_pairs(urls, locations).select(
        F.col("shorter").alias("Location"), F.col("longer").alias("url")
    )
    return _with_names(inside.unionByName(around).distinct(), named)


def _with_names(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """Each pair (Location, url) with every name of its url.

    A url of many names that many roots match has most of the result on one key. Its roots are dealt
    over as many parts as it has rows to give, a part with all names, so that a part gives about
    ``PART_ROWS`` rows whoever owns them. The rows are not shuffled again.
    """
    pairs = staged(pairs, "location-pairs")
    sizes = (
        pairs.groupBy("url").agg(F.count("*").alias("_roots"))
        .join(named.groupBy("url").agg(F.count("*").alias("_names")), "url")
        .withColumn("_rows", F.col("_roots") * F.col("_names"))
        .withColumn("_parts", F.least("_roots", F.ceil(F.col("_rows") / PART_ROWS)))
    )
    rows = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    least = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(2, least, min(3 * rows // PART_ROWS, MOST_TASKS))
    parts = sizes.select("url", "_parts")
    dealt = pairs.join(parts, "url").withColumn("_part", F.pmod(F.xxhash64("Location"), F.col("_parts")))
    numbers = F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)
    repeated = named.join(parts, "url").withColumn("_part", F.explode(numbers))
    # a number of partitions of its own: by bytes, the few rows before the join would be merged into one task
    keys = ["url", "_part"]
    return (
        dealt.drop("_parts").repartition(tasks, *keys)
        .join(repeated.drop("_parts").repartition(tasks, *keys), keys)
        .select("Location", "name", "url")
    )


def matched_names(roots: DataFrame, ext_locations: DataFrame) -> DataFrame:
    """Names of the external locations that match any root, without forming the pairs: semi-joins
    of the urls with the distinct cuts of the roots, and of the urls' cuts with the roots."""
    named = ext_locations.select("name", F.col("url").alias("text"))
    locations = roots.select(F.col("Location").alias("text"))
    inside = named.join(contained_texts(locations, named.select("text")), "text", "left_semi")
    around = named.join(containing_texts(named.select("text"), locations), "text", "left_semi")
    return inside.select("name").unionByName(around.select("name")).distinct()


def executor_grants(
    source_catalog: str,
    source_databases: DataFrame,
    target_catalog: str,
    target_databases: DataFrame,
    matches: DataFrame,
    principal: str,
) -> DataFrame:
    """Statements that let one account read the source, write the target and use its storage.

    ``matches`` holds the names of the storage (``matched_names``, or rows of ``match_locations``)."""
    to = f" TO {quoted_literal(principal)} ;"

    def on_catalog(catalog: str) -> DataFrame:
        return (
            matches.sparkSession.range(1)
            .select(F.lit(f"GRANT USE_CATALOG ON CATALOG {quoted_literal(catalog)}{to}"))
            .toDF("statement")
        )

    def on_schemas(catalog: str, databases: DataFrame, privileges: tuple[str, ...]) -> DataFrame:
        privilege = F.explode(F.array(*[F.lit(p) for p in privileges])).alias("privilege")
        return (
            with_database_column(databases)
            .select("database")
            .distinct()
            .select("database", privilege)
            .select(
                sql_text(
                    "GRANT ",
                    F.col("privilege"),
                    f" ON SCHEMA {quoted_literal(catalog)}.",
                    quote(F.col("database")),
                    to,
                ).alias("statement")
            )
        )

    on_locations = (
        matches.select("name")
        .distinct()
        .select(
            sql_text(
                "GRANT CREATE EXTERNAL TABLE ON EXTERNAL LOCATION ", quote(F.col("name")), to
            ).alias("statement")
        )
    )
    return (
        on_catalog(source_catalog)
        .unionByName(on_catalog(target_catalog))
        .unionByName(on_schemas(source_catalog, source_databases, SOURCE_PRIVILEGES))
        .unionByName(on_schemas(target_catalog, target_databases, TARGET_PRIVILEGES))
        .unionByName(on_locations)
    )
