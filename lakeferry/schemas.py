"""Relations the operators read and write (all strings unless a type says otherwise)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


INVENTORY = _strings(
    "database", "tableName", "isTemporary", "Type", "Provider", "Location", "Serde Library", "Error"
)
TABLE_DETAILS = _strings(
    "database", "tableName", "storage_location", "storage_format", "table_type", "managed", "error"
)
STATUS = _strings(
    "source_schema",
    "source_name",
    "source_type",
    "target_catalog",
    "target_schema",
    "target_name",
    "status_code",
    "description",
)
GRANTS = _strings("Principal", "ActionType", "ObjectType", "ObjectName")
GRANTS_WITH_ERROR = _strings("Principal", "ActionType", "ObjectType", "ObjectName", "Error")
EXTERNAL_LOCATIONS = _strings("name", "url")
GROUPS = _strings("id", "group_name", "uc_group_name")
PERMISSIONS = _strings(
    "name",
    "id",
    "old_group_names",
    "new_group_names",
    "permission_level",
    "permission_update_status",
    "artifact_type",
)
JOB_BACKUP = StructType(
    [StructField("job_id", LongType(), True), StructField("cluster_config", StringType(), True)]
)
ACL_ENTRIES = ArrayType(
    StructType(
        [
            StructField("group_name", StringType(), True),
            StructField("permissions", ArrayType(StringType()), True),
        ]
    )
)
SECRET_ACL_ENTRIES = ArrayType(_strings("group_name", "permissions"))
