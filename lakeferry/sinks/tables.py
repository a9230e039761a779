"""Writers. Rows are rebalanced by partition column, so a small partition lands in one file and
a partition holding most rows is split over several tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.functions import REJECTED
from lakeferry.operators.acl import ANSWER_KEYS, permission_status
from lakeferry.operators.externalize import externalize as externalize_table
from lakeferry.operators.externalize import quoted_text
from lakeferry.operators.jobs import job_backups
from lakeferry.schemas import PERMISSIONS
from lakeferry.session import folder_names, remove, shuffles_removed, temporarily_staged

__all__ = [
    "backup_configs",
    "externalize_table",
    "status_documents",
    "table_location",
    "update_permissions",
    "write_checked",
    "write_grants",
    "write_inventory",
    "write_permissions",
]


#: A file costs a task more than the few rows of a usual database, so databases are dealt by number.
DATABASES_A_TASK = 200
ROWS_A_FILE = 500_000


def write_inventory(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Inventory as Parquet with one directory per database; a second write fails.

    Tasks get about ``DATABASES_A_TASK`` files each, however few bytes these are. A database of more
    than ``ROWS_A_FILE`` rows is written in parts by several tasks.
    """
    counted = df.groupBy("database").agg(F.ceil(F.count("*") / ROWS_A_FILE).alias("_parts"))
    with temporarily_staged(counted, "inventory-parts") as parts:
        files = parts.agg(F.sum("_parts")).first()[0] or 1
        part = F.pmod(F.xxhash64(*df.columns), F.coalesce("_parts", F.lit(1)))
        df.join(parts.where("_parts > 1"), "database", "left").withColumn("_part", part).repartition(
            -(-files // DATABASES_A_TASK), "database", "_part"
        ).select(*df.columns).write.mode(mode).partitionBy("database").parquet(path)


def write_checked(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """What an operator read with ``rejects``: accepted rows and the reject table, from one parse.

    ``sources.accepted`` and ``sources.rejected`` read them; each reads its own folder only.
    """
    rows = df.withColumn("is_rejected", F.col(REJECTED).isNotNull())
    rows.write.mode(mode).partitionBy("is_rejected").parquet(path)


def write_grants(
    df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None
) -> None:
    """Grant table: extracts and new-catalog results overwrite, old-catalog results append."""
    writer = df.write.mode(mode).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_permissions(df: DataFrame, table: str, path: str | None = None) -> None:
    """Permission table partitioned by artifact type; replaces only the types present in ``df``.

    The rows are written once, to a version folder of their own inside the table's, and then the
    partitions are pointed to it one by one. So ``df`` may read the table itself; a write that fails
    leaves every partition as it was; writers of different types can work at the same time.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        rows = df.select(*PERMISSIONS.names).hint("rebalance", F.col("artifact_type"))
        writer = rows.write.format("parquet").option("compression", COMPRESSION).partitionBy("artifact_type")
        if path is not None:
            writer = writer.option("path", path)
        with shuffles_removed(spark):
            writer.saveAsTable(table)
        return
    _write_version(spark, table, [df])


def _write_version(spark: SparkSession, table: str, frames: Iterable[DataFrame]) -> None:
    """Writes the frames to one new version, each when the shuffles of the one before it have left the
    disks, and then points the partitions to it."""
    version = f"{table_location(spark, table)}/{VERSIONS}/{uuid.uuid4().hex}"
    columns = spark.table(table).columns
    try:
        for df in frames:
            rows = df.select(*columns).hint("rebalance", F.col("artifact_type"))
            with shuffles_removed(spark):
                rows.write.mode("append").partitionBy("artifact_type").parquet(version, compression=COMPRESSION)
    except Exception:
        remove(spark, version)
        raise
    _point_to(spark, table, version)


#: Permission rows repeat few long names; they are written several times over.
COMPRESSION = "zstd"
#: Folder inside a table's folder, left out by readers of that folder, that holds written versions.
VERSIONS = "_versions"


def _point_to(spark: SparkSession, table: str, version: str) -> None:
    """Makes the folders of ``version`` the partitions of their types and removes the former ones.

    A pointer changes in one step of the catalog; there is one for each artifact type.
    """
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    former = []
    for name in folder_names(spark, version):
        column, _, value = name.partition("=")
        if not value:
            continue
        spec = f"PARTITION ({column} = {quoted_text(unescape(value))})"
        place = quoted_text(f"{version}/{name}")
        if spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION {place}")
            continue
        former.append(partition_location(spark, table, spec))
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {place}")
    spark.catalog.refreshTable(table)
    for folder in former:
        remove(spark, folder)


def partition_location(spark: SparkSession, table: str, spec: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").collect()
    at = next(i for i, r in enumerate(rows) if r["col_name"] == "# Detailed Partition Information")
    return next(r["data_type"] for r in rows[at:] if r["col_name"] == "Location")


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return rows.where("col_name = 'Location'").first()["data_type"]


#: Rows of the table and of the responses that meet in one round of an update; each takes about
#: 45 bytes of shuffles while the round lasts.
ROWS_A_ROUND = 120_000_000


def update_permissions(spark: SparkSession, table: str, responses: DataFrame) -> None:
    """Write response statuses back into the partitions of the stored table that they belong to.

    Each row is written once: the new version of a partition is complete before it takes the place of
    the one it was read from. Large tables are updated in rounds, so that shuffles fill no more of the
    disks than ``ROWS_A_ROUND`` rows take.
    """
    stored = spark.table(table)
    rounds = _rounds(stored, responses)
    if rounds:
        updated = (permission_status(stored.where(rows), responses.where(rows)) for rows in rounds)
        _write_version(spark, table, updated)


def _rounds(stored: DataFrame, responses: DataFrame) -> list[Column]:
    """Conditions on both frames that share out the answered types: several small types, one, or a
    part of the keys of a large one."""
    kind = F.col("artifact_type")
    with shuffles_removed(stored.sparkSession):
        held = {r[0]: r[1] for r in stored.where(kind.isNotNull()).groupBy(kind).count().collect()}
        answered = responses.where(kind.isin(list(held))).groupBy(kind).count().collect()
    keys = [k for k in ANSWER_KEYS if k != "artifact_type"]
    # equal keys of different data types have different hashes
    divisible = all(stored.schema[k].dataType == responses.schema[k].dataType for k in keys)
    together, room, rounds = [[]], ROWS_A_ROUND, []
    for size, label in sorted((held[label] + answers, label) for label, answers in answered):
        if divisible and size > ROWS_A_ROUND:
            parts = -(-size // ROWS_A_ROUND)
            part = F.pmod(F.xxhash64(*keys), F.lit(parts))
            rounds += [(kind == label) & (part == i) for i in range(parts)]
            continue
        if size > room:
            together.append([])
            room = ROWS_A_ROUND
        together[-1].append(label)
        room -= size
    return [kind.isin(labels) for labels in together if labels] + rounds


def backup_configs(jobs: DataFrame, table: str, path: str | None = None) -> None:
    """Append the present job-cluster configuration of every job to the backup table."""
    rows = job_backups(jobs).withColumn("recorded_at", F.current_timestamp())
    writer = rows.write.mode("append").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def status_documents(status: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Status rows as JSON record files, written by all tasks (no single document)."""
    status.write.mode(mode).json(path)
