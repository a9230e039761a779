"""Editing JSON text by regular expressions, inside the JVM.

Only documents that mention a key are edited. Text that stays (strings that are no such key, whole lists,
everything between them) is matched in long possessive runs, a dropped member with its value and its comma
as one match, so a text is read once, in time linear in its length. What stays does so as it is written:
numbers, escapes and order survive. Objects inside lists are left alone.

Patterns find matching brackets by nesting to a number of levels. A text with more opening brackets than
the usual pattern has levels gets a pattern of the most levels that a task's stack compiles safely. A text
nested deeper than those is told as not editable (``is_editable``), never edited in part.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

USUAL_LEVELS = 32
MOST_LEVELS = 400

_STRING = r'"(?:[^"\\]++|\\.)*+"'
_INSIDE = rf'(?:[^"\[\]{{}}]++|{_STRING}'
_OPEN, _CLOSE = rf"|[\[{{]{_INSIDE}", r")*+[\]}]"
_LAST_COMMA = rf"({_STRING})|,\s*+(?=\}})"
# JSON's short escapes.
_SHORT = {'"': '"', "\\": "\\", "/": "/", "\b": "b", "\f": "f", "\n": "n", "\r": "r", "\t": "t"}


def is_object(json_text: Column) -> Column:
    """Whether a text is one JSON object and nothing else (null for a null text).

    The parser stops after the first value, so the text is parsed as the first of two: a text that
    closes the list itself, or goes on behind its object, does not leave the mark in second place.
    """
    mark = F.xxhash64(json_text).cast("string")
    pair = F.try_parse_json(F.concat(F.lit("["), json_text, F.lit(',"'), mark, F.lit('"]')))
    second = F.try_variant_get(pair, "$[1]", "string")
    return F.ltrim(json_text).startswith("{") & F.coalesce(second == mark, F.lit(False))


def mentions_any(json_text: Column, keys: Sequence[str]) -> Column:
    """Whether a key can occur in the text, spelled out or with an escape; guards the edit."""
    plain = [F.contains(json_text, F.lit(key)) for key in keys]
    return reduce(lambda a, b: a | b, plain, F.contains(json_text, F.lit("\\")))


def _spelled(character: str) -> str:
    """Pattern of all the ways in which a JSON string can write a character."""
    units = character.encode("utf-16-be").hex()
    hexes = "".join(f"[{h}{h.upper()}]" if h.isalpha() else h for h in units)
    ways = ["".join(r"\\u" + part for part in re.findall(r"(?:\[..\]|.){4}", hexes))]
    if character in _SHORT:
        ways.append(r"\\" + re.escape(_SHORT[character]))
    if character not in '"\\' and character >= " ":
        ways.insert(0, re.escape(character))
    return f"(?:{'|'.join(ways)})"


def _member_name(keys: Iterable[str]) -> str:
    """Pattern of a member's name, one of ``keys``, with its colon."""
    return rf'"(?:{"|".join("".join(map(_spelled, key)) for key in sorted(keys))})"\s*+:'


def _brackets(json_text: Column) -> Column:
    closed = F.replace(F.replace(json_text, F.lit("["), F.lit("")), F.lit("{"), F.lit(""))
    return F.length(json_text) - F.length(closed)


def _levels(json_text: Column) -> Column:
    deep = _brackets(json_text) > USUAL_LEVELS
    return F.when(deep, F.lit(MOST_LEVELS)).otherwise(F.lit(USUAL_LEVELS))


def _pattern(levels: Column, *parts: str) -> Column:
    """Pattern of ``parts``; between them stands what closes the bracket that the part before opened."""
    nested = F.concat(F.lit(_INSIDE), F.repeat(F.lit(_OPEN), levels - 1), F.repeat(F.lit(_CLOSE), levels))
    pieces: list[Column] = [F.lit("(?s)" + parts[0])]
    for part in parts[1:]:
        pieces += [nested, F.lit(part)]
    return F.concat(*pieces)


def is_editable(json_text: Column) -> Column:
    """Whether a text is one JSON object of at most ``MOST_LEVELS`` levels (null for a null text)."""
    outer = _pattern(_levels(json_text), r"^\s*+\{", r"\s*+$")
    shallow = (_brackets(json_text) <= MOST_LEVELS) | F.regexp_like(json_text, outer)
    return is_object(json_text) & shallow


def _without(json_text: Column, levels: Column, keys: Iterable[str], whole: str, opening: str) -> Column:
    """The text without the members ``keys``, each with the comma behind it.

    Brackets of the kind ``opening`` are passed over as a whole; ``whole`` are characters that mean nothing.
    """
    name = _member_name(keys)
    stays = rf"((?:{whole}++|\s++(?!{name})|(?!{name}){_STRING}|{opening}"
    value = rf")++)|\s*+{name}\s*+(?:{_STRING}|[^\s,\[\]{{}}\"]++|[\[{{]"
    return F.regexp_replace(json_text, _pattern(levels, stays, value, r")\s*+,?+"), F.lit("$1"))


def _dropped(json_text: Column, keys: Iterable[str]) -> Column:
    rest = _without(json_text, _levels(json_text), keys, r'[^"\[\s]', r"\[")
    return F.regexp_replace(rest, F.lit(_LAST_COMMA), F.lit("$1"))


def drop_keys(json_text: Column, keys: Sequence[str]) -> Column:
    """Remove ``keys`` from an object and from every object nested in it, but not inside lists.

    A text that is no JSON object, or is nested too deep, comes back as it is.
    """
    if not keys:
        return json_text
    concerned = mentions_any(json_text, keys) & is_editable(json_text)
    return F.when(concerned, _dropped(json_text, keys)).otherwise(json_text)


def replace_members(
    json_text: Column, member: str, values: Mapping[str, str], drop: Sequence[str] = ()
) -> Column:
    """Set members of the object ``member`` of a JSON object to ``values`` (JSON texts) and remove
    the keys ``drop`` everywhere but inside lists; the text must be null or editable.

    New members come last. A name that repeats is replaced in each of its objects.
    """
    start, levels = json_text, _levels(json_text)
    if drop:
        start = F.when(mentions_any(json_text, drop), _dropped(json_text, drop)).otherwise(json_text)
    added = ",".join(f"{json.dumps(k)}:{v}" for k, v in values.items())
    if not added:
        return start
    name = _member_name([member])
    head = rf"(?s)^{name}\s*+\{{"
    # The text up to the first member, members passed over, and each object ``member`` as a part of its own.
    passed = rf'^\s*+\{{|(?:[^"\[{{]++|(?!{name}\s*+\{{){_STRING}|[\[{{]'
    pattern = _pattern(levels, passed, rf")++|{name}\s*+\{{", "")

    def changed(part: Column) -> Column:
        inside = F.regexp_extract(part, head + r"(.*)\}$", 1)
        kept = _without(inside, levels, values, r'[^"\[{\s]', r"[\[{]")
        listed = F.regexp_replace(kept, r"([^\s,])(\s*+)\z", "$1$2,")
        return F.concat(F.regexp_extract(part, head, 0), listed, F.lit(added + "}"))

    def edited(text: Column) -> Column:
        parts = F.regexp_extract_all(text, pattern, F.lit(0))
        done = F.transform(parts, lambda p: F.when(F.regexp_like(p, F.lit(head)), changed(p)).otherwise(p))
        return F.when(text.isNotNull(), F.array_join(done, ""))

    # The lambda binds the text without its dropped members, so that it is made once.
    return F.transform(F.array(start), edited)[0]
