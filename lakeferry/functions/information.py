"""Reading the ``key: value`` text of an extended table listing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column names of the table follow this line, so a column called "Type" must not be read as one.
_SCHEMA_LINE = "\nSchema: root"


def information_value(information: Column, key: str, trim: bool = True) -> Column:
    """Value of the last ``key:`` line above the schema block, null without such a line.

    Equal to ``str_to_map(..., LAST_WIN)[key]`` on that block, but independent of the session's
    ``spark.sql.mapKeyDedupPolicy``. ``trim=False`` keeps the blank after the colon.
    """
    lines = F.split(F.substring_index(information, _SCHEMA_LINE, 1), "\n")
    last = F.try_element_at(F.filter(lines, lambda line: line.startswith(f"{key}:")), F.lit(-1))
    value = F.substr(last, F.lit(len(key) + 2))
    return F.trim(value) if trim else value
