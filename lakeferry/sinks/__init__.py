from lakeferry.sinks.tables import (
    backup_configs,
    externalize_table,
    status_documents,
    update_permissions,
    write_checked,
    write_grants,
    write_inventory,
    write_permissions,
)

__all__ = [
    "backup_configs",
    "externalize_table",
    "status_documents",
    "update_permissions",
    "write_checked",
    "write_grants",
    "write_inventory",
    "write_permissions",
]
