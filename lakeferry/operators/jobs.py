"""Job-cluster configuration: first cluster, eligibility, upgrade, backup and restore."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from lakeferry.functions import drop_keys, is_editable, is_object, last_answer, replace_members

# Settings of the old proxy user, removed at every object level.
PROXY_USER_KEYS = ("HADOOP_USER_NAME", "HADOOP_PROXY_USER")
MIN_VERSION = 10

UPDATED = "updated"
NOT_ELIGIBLE = "not eligible"
NO_CLUSTER = "no job cluster"
NO_RESPONSE = "no response"
NO_BACKUP = "no backup"
UNREADABLE_BACKUP = "unreadable backup"
NO_NEW_CLUSTER = "no new_cluster"
UNREADABLE_CLUSTER = "unreadable cluster"


def job_clusters(df: DataFrame, doc: str = "job_json") -> DataFrame:
    """(job_id, cluster): the first job cluster of each job document as JSON text, or null."""
    return df.select(
        "job_id", F.get_json_object(F.col(doc), "$.settings.job_clusters[0]").alias("cluster")
    )


def is_eligible(cluster: Column) -> Column:
    version = F.get_json_object(cluster, "$.new_cluster.spark_version")
    major = F.trim(F.substring_index(version, ".", 1)).try_cast("int")
    return F.coalesce(major >= MIN_VERSION, F.lit(False))


def eligible(df: DataFrame) -> DataFrame:
    """Add ``eligible``: the number before the first dot of the runtime version is at least 10.
    A version that does not start with a number is not eligible."""
    return df.withColumn("eligible", is_eligible(F.col("cluster")))


def strip_keys(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Remove ``keys`` from every object level of a column, lists left alone.

    A string column is JSON text: its other members stay as they are written, and a text that is no
    JSON object, or is nested deeper than 400 levels, comes back unchanged. Struct and map columns are walked along their type.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, (StructType, MapType)):
        return df.withColumn(column, _strip_typed(F.col(column), kind, list(keys)))
    return df.withColumn(column, drop_keys(F.col(column), keys))


def _strip_typed(value: Column, kind, keys: list[str]) -> Column:
    if isinstance(kind, MapType):
        kept = F.map_filter(value, lambda k, _: ~k.isin(keys))
        if isinstance(kind.valueType, (StructType, MapType)):
            return F.transform_values(kept, lambda _, v: _strip_typed(v, kind.valueType, keys))
        return kept
    if isinstance(kind, StructType):
        fields = [
            _strip_typed(value[f.name], f.dataType, keys).alias(f.name)
            for f in kind.fields
            if f.name not in keys
        ]
        if not fields:
            return F.create_map().cast("map<string,string>")
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def _update_body(job_id: Column, cluster_json: Column) -> Column:
    """The update document around a cluster that already is JSON text."""
    return F.concat(
        F.lit('{"job_id":'),
        job_id.cast("string"),
        F.lit(',"new_settings":{"job_clusters":['),
        cluster_json,
        F.lit("]}}"),
    )


def upgrade_payload(
    df: DataFrame,
    version: str,
    conf: Mapping[str, str],
    mode: str,
    drop: Sequence[str] = PROXY_USER_KEYS,
) -> DataFrame:
    """(job_id, payload, message): cluster with the new version, ``conf`` in place of its spark_conf
    and the new access mode, proxy-user keys removed.

    A cluster that cannot be read (or is nested deeper than 400 levels), or has no ``new_cluster`` object, gives a message and no payload.
    """
    settings = {
        "spark_version": json.dumps(version),
        "spark_conf": json.dumps(dict(conf), separators=(",", ":")),
        "data_security_mode": json.dumps(mode),
    }
    cluster = F.col("cluster")
    inner = F.get_json_object(cluster, "$.new_cluster")
    message = (
        F.when(cluster.isNull(), F.lit(NO_CLUSTER))
        .when(~is_editable(cluster), F.lit(UNREADABLE_CLUSTER))
        .when(~F.coalesce(F.ltrim(inner).startswith("{"), F.lit(False)), F.lit(NO_NEW_CLUSTER))
        .otherwise(F.lit(""))
    )
    checked = df.select("job_id", "cluster", message.alias("message"))
    readable = F.when(F.col("message") == "", F.col("cluster"))
    body = replace_members(readable, "new_cluster", settings, drop)
    return checked.select("job_id", _update_body(F.col("job_id"), body).alias("payload"), "message")


def job_backups(df: DataFrame) -> DataFrame:
    """(job_id, cluster_config) of every job that has a job cluster, eligible or not."""
    return df.where(F.col("cluster").isNotNull()).select(
        F.col("job_id").cast("bigint").alias("job_id"), F.col("cluster").alias("cluster_config")
    )


def upgrade_outcome(jobs: DataFrame, responses: DataFrame) -> DataFrame:
    """(job_id, outcome) from jobs (job_id, cluster) and responses (job_id, status_code, content,
    answered_at); the last answer of a job counts."""
    answered = last_answer(responses, ["job_id"], "status_code", "content")
    outcome = (
        F.when(F.col("cluster").isNull(), F.lit(NO_CLUSTER))
        .when(~F.col("eligible"), F.lit(NOT_ELIGIBLE))
        .when(F.col("answer").isNull(), F.lit(NO_RESPONSE))
        .when(F.col("answer.status_code") == 200, F.lit(UPDATED))
        .otherwise(F.concat(F.lit("error: "), F.coalesce(F.col("answer.content"), F.lit(""))))
    )
    return (
        eligible(jobs.select("job_id", "cluster"))
        .join(answered, "job_id", "left")
        .select("job_id", outcome.alias("outcome"))
    )


def restore_payload(backups: DataFrame, job_ids: DataFrame) -> DataFrame:
    """(job_id, payload, message): update document from the newest backup of each job.

    A newest backup that is no JSON object gives a message and no payload; an older one never takes
    its place. Backups without ``recorded_at`` count as equally old; the largest text decides then.
    """
    newest = last_answer(backups, ["job_id"], "cluster_config", time="recorded_at")
    config = F.col("answer.cluster_config")
    message = (
        F.when(F.col("answer").isNull(), F.lit(NO_BACKUP))
        .when(~F.coalesce(is_object(config), F.lit(False)), F.lit(UNREADABLE_BACKUP))
        .otherwise(F.lit(""))
    )
    return (
        job_ids.select("job_id")
        .distinct()
        .join(newest, "job_id", "left")
        .select("job_id", config.alias("config"), message.alias("message"))
        .select(
            "job_id",
            F.when(F.col("message") == "", _update_body(F.col("job_id"), F.col("config"))).alias("payload"),
            "message",
        )
    )
