from lakeferry.functions.documents import REJECTED, with_parsed
from lakeferry.functions.information import information_value
from lakeferry.functions.joins import grouped_lookup, last_answer, lookup
from lakeferry.functions.json_objects import drop_keys, is_editable, is_object, replace_members
from lakeferry.functions.names import quote, quote_if_needed, quoted_literal, sql_text
from lakeferry.functions.paths import (
    contained_texts,
    containing_texts,
    contains_pairs,
    path_prefixes,
)

__all__ = [
    "REJECTED",
    "contained_texts",
    "containing_texts",
    "contains_pairs",
    "drop_keys",
    "grouped_lookup",
    "information_value",
    "is_editable",
    "is_object",
    "last_answer",
    "lookup",
    "path_prefixes",
    "quote",
    "quote_if_needed",
    "quoted_literal",
    "replace_members",
    "sql_text",
    "with_parsed",
]
