from lakeferry.sources.landed import (
    accepted,
    grants_table,
    json_documents,
    json_pages,
    permissions_of,
    rejected,
    stored_inventory,
    table_snapshot,
)

__all__ = [
    "accepted",
    "grants_table",
    "json_documents",
    "json_pages",
    "permissions_of",
    "rejected",
    "stored_inventory",
    "table_snapshot",
]
