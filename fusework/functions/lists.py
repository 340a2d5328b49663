"""Serialized lists: parsing and joining."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fusework.functions.text import strip

# one item of a flat literal list: quoted text, a number or a constant
_SINGLE = r"'[^'\\]*(?:\\.[^'\\]*)*'"
_DOUBLE = r'"[^"\\]*(?:\\.[^"\\]*)*"'
_ITEM = rf"(?:{_SINGLE}|{_DOUBLE}|[+-]?\d+(?:\.\d+)?|None|True|False)"
_LIST = rf"^\[\s*{_ITEM}(?:\s*,\s*{_ITEM})*\s*,?\s*\]$"


def _unquote_literal(item: Column) -> Column:
    quoted = item.rlike(r"""^['"]""")
    body = F.regexp_replace(F.substr(item, F.lit(2), F.length(item) - 2), r"\\(.)", "$1")
    return strip(F.when(quoted, body).otherwise(item))


def _strip_quotes(item: Column) -> Column:
    no_single = F.regexp_replace(strip(item), r"^'+|'+$", "")
    return F.regexp_replace(no_single, r'^"+|"+$', "")


def _non_empty(items: Column) -> Column:
    return F.filter(items, lambda x: x != "")


def parse_list_field(text: Column) -> Column:
    """A flat list literal, or text separated by comma, semicolon or bar, as ``array<string>``."""
    raw = strip(text)
    literal = F.transform(F.regexp_extract_all(raw, F.lit(f"({_ITEM})"), F.lit(0)), _unquote_literal)
    bare = F.regexp_replace(raw, r"^[\[\]()]+|[\[\]()]+$", "")
    pieces = F.transform(F.split(bare, r"[,;|]"), _strip_quotes)
    empty = F.array().cast("array<string>")
    return (
        F.when(raw.isNull() | raw.isin("", "[]", "nan", "None", "null"), empty)
        .when(raw.rlike(_LIST), _non_empty(literal))
        .otherwise(_non_empty(pieces))
    )


def ensure_list(text: Column) -> Column:
    """The list reader for values that went through text once more: no bracket stripping."""
    raw = strip(text)
    literal = F.transform(F.regexp_extract_all(raw, F.lit(f"({_ITEM})"), F.lit(0)), _unquote_literal)
    pieces = _non_empty(F.transform(F.split(raw, r"[,;|]"), strip))
    empty = F.array().cast("array<string>")
    return (
        F.when(raw.isNull() | raw.isin("", "nan", "None", "[]"), empty)
        .when(raw.rlike(_LIST), literal)
        .otherwise(pieces)
    )


def join_list(items: Column) -> Column:
    return F.array_join(items, ", ")
