"""Text normalization as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

from fusework.config import GENRE_MAP, UNKNOWN


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """(from, to) for ``translate``: accented letters to their base letter, marks to nothing.

    ``translate`` deletes the characters of the first text that have no partner in the second.
    """
    letters, bases, marks = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if unicodedata.category(ch) == "Mn":
            marks.append(ch)
            continue
        parts = unicodedata.normalize("NFD", ch)
        if parts == ch:
            continue
        kept = [c for c in parts if unicodedata.category(c) != "Mn"]
        if len(kept) == 1:
            letters.append(ch)
            bases.append(kept[0])
    return "".join(letters + marks), "".join(bases)


# everything that counts as blank at the ends of a text
_BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def strip_accents(text: Column) -> Column:
    source, target = _accent_table()
    return F.translate(text, source, target)


def _blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_basic_text(text: Column) -> Column:
    """Lower case, no accents, letters and digits only, single spaces, empty is NULL."""
    plain = strip_accents(F.lower(text))
    return _blank_to_null(_collapse(F.regexp_replace(plain, r"[^a-z0-9\s]", " ")))


def normalize_title(text: Column) -> Column:
    """Key by which titles of two sources are compared."""
    key = strip_accents(F.lower(text))
    key = F.regexp_replace(key, r"\(\s*\d{4}\s*\)", " ")
    key = F.regexp_replace(key, r"(?<![\p{L}\p{N}_])\d{4}(?![\p{L}\p{N}_])", " ")
    key = F.replace(key, F.lit("&"), F.lit(" and "))
    key = _collapse(F.regexp_replace(key, r"[^a-z0-9\s]", " "))
    return _blank_to_null(F.regexp_replace(key, r"^(the|a|an)\s+", ""))


def title_case(text: Column) -> Column:
    """Capital after every non-letter: film-noir becomes Film-Noir."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def normalize_genre(genre: Column) -> Column:
    original = strip(genre)
    key = F.regexp_replace(F.lower(strip_accents(original)), r"[^a-z0-9\s\-]", " ")
    table = F.create_map(*[F.lit(x) for pair in GENRE_MAP.items() for x in pair])
    return F.coalesce(F.element_at(table, _collapse(key)), title_case(original))


def normalize_genres(genres: Column) -> Column:
    """Canonical distinct genres in order of appearance, ``[Unknown]`` when there are none."""
    names = F.filter(
        F.transform(F.coalesce(genres, F.array().cast("array<string>")), normalize_genre),
        lambda g: g.isNotNull() & (g != ""),
    )
    # a lambda variable: mentioned twice, the names would be computed twice
    known = F.transform(F.array(F.array_distinct(names)), lambda d: F.when(F.size(d) > 0, d).otherwise(F.array(F.lit(UNKNOWN))))
    return known[0]


def clean_code(text: Column) -> Column:
    return F.lower(strip(text))


def fill_blank_text(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit("")))


def block_key_first_letter(key: Column) -> Column:
    return _blank_to_null(F.substring(strip(key), 1, 1))


def main_title_token(key: Column) -> Column:
    return _blank_to_null(F.split(strip(key), r"\s+")[0])
