"""Typed parsers as column expressions. Bad input gives NULL, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from fusework.config import DEFAULTS, Settings
from fusework.functions.text import strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def numeric_coerce(value: Column) -> Column:
    """The number a text holds, NULL for anything else; NaN counts as missing."""
    return F.regexp_extract(strip(value.cast("string")), _NUMBER, 0).try_cast("double")


def parse_runtime(value: Column, settings: Settings = DEFAULTS) -> Column:
    """Free-text duration as ``struct<minutes, status>``."""
    clock = r"^(\d{1,3}):(\d{2})$"
    words = r"^(?:(\d+)\s*(?:hours?|hrs?|h))?\s*(?:(\d+)\s*(?:minutes?|mins?|m))?"
    alone = r"^(\d+)\s*(?:minutes?|mins?|m)?$"
    floor = F.lit(settings.runtime_min_plausible)

    def result(status: str, minutes: Column | None = None) -> Column:
        v = F.lit(None).cast("double") if minutes is None else minutes
        return F.struct(v.alias("minutes"), F.lit(status).alias("status"))

    def part(raw: Column, pattern: str, group: int) -> Column:
        return F.regexp_extract(raw, pattern, group).try_cast("double")

    def readings(raw: Column) -> Column:
        zero = F.lit(0.0)
        return F.struct(
            raw.alias("raw"),
            (part(raw, clock, 1) * 60 + part(raw, clock, 2)).alias("clock"),
            (F.coalesce(part(raw, words, 1), zero) * 60 + F.coalesce(part(raw, words, 2), zero)).alias("words"),
            part(raw, alone, 1).alias("alone"),
            numeric_coerce(raw).alias("number"),
        )

    def choose(r: Column) -> Column:
        raw = r["raw"]
        return (
            F.when(raw.isNull() | raw.isin("", "nan", "none", "null"), result("missing"))
            .when(raw.contains("not-released") | raw.contains("not released"), result("not_released"))
            .when(raw.contains("$") | raw.contains("estimated"), result("money_in_runtime"))
            .when(r["clock"].isNotNull(), result("parsed_hhmm", r["clock"]))
            .when(r["words"] > 0, result("parsed_text", r["words"]))
            .when(r["alone"] < floor, result("too_small_probably_not_runtime"))
            .when(r["alone"].isNotNull(), result("parsed_minutes", r["alone"]))
            .when(r["number"] < floor, result("too_small_probably_rating"))
            .when(r["number"].isNotNull(), result("parsed_numeric", r["number"]))
            .otherwise(result("unparsed"))
        )

    return _let(readings(F.lower(strip(value))), choose)


def parse_money(value: Column) -> Column:
    """Money as ``struct<value, was_zero, status>``; zero means "not reported"."""
    raw = strip(value)
    bare = F.regexp_replace(F.regexp_replace(raw, r"\(.*?\)", ""), r"[$,]", "")

    def result(status: str, amount: Column | None = None) -> Column:
        v = F.lit(None).cast("double") if amount is None else amount
        return F.struct(
            v.alias("value"),
            F.lit(status == "zero_as_missing").alias("was_zero"),
            F.lit(status).alias("status"),
        )

    def choose(m: Column) -> Column:
        text, amount = m["raw"], m["amount"]
        return (
            F.when(text.isNull() | text.isin("", "nan", "None", "null"), result("missing"))
            .when(amount == 0, result("zero_as_missing"))
            .when(amount < 0, result("negative_invalid"))
            .when(amount > 0, result("valid", amount))
            .otherwise(result("unparsed"))
        )

    return _let(F.struct(raw.alias("raw"), numeric_coerce(bare).alias("amount")), choose)


def parse_count_suffix(value: Column) -> Column:
    """187K, 1.2M, 2b or 1,500 as a number."""
    raw = F.replace(F.upper(strip(value)), F.lit(","), F.lit(""))
    pattern = r"^([\d.]+)\s*([KMB]?)$"
    suffix = F.regexp_extract(raw, pattern, 2)
    factor = (
        F.when(suffix == "K", F.lit(1e3))
        .when(suffix == "M", F.lit(1e6))
        .when(suffix == "B", F.lit(1e9))
        .otherwise(F.lit(1.0))
    )
    return numeric_coerce(F.regexp_extract(raw, pattern, 1)) * factor


def clean_year(value: Column, settings: Settings = DEFAULTS) -> Column:
    # the range is tested on the number, so the integer cast can never overflow
    year = F.floor(F.abs(numeric_coerce(value)))
    return F.when(year.between(settings.year_min, settings.year_max), year.cast("int"))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def year_out_of_range(year: Column, settings: Settings = DEFAULTS) -> Column:
    return (year < settings.year_min) | (year > settings.year_max)


def parse_date(value: Column) -> Column:
    return F.try_to_date(strip(value), "yyyy-MM-dd")


def repair_negative_year(number: Column) -> Column:
    """``struct<year, was_negative>`` of a number: years whose sign was lost in transit."""
    size = F.abs(number)
    # the range is tested on the number, so the integer cast cannot overflow
    year = F.when(size < 1e9, size.cast("int"))
    return F.struct(year.alias("year"), (number < 0).alias("was_negative"))


def first_day_of_year(year: Column) -> Column:
    return F.when(year.between(1, 9999), F.make_date(year, F.lit(1), F.lit(1)))


def runtime_range_guard(number: Column, settings: Settings = DEFAULTS) -> Column:
    """``struct<minutes, was_zero, out_of_range, missing>`` of a number of minutes."""
    bad = F.coalesce((number <= 0) | (number > settings.runtime_max), F.lit(False))
    kept = F.when(~bad, number)
    return F.struct(
        kept.alias("minutes"),
        F.coalesce(number == 0, F.lit(False)).alias("was_zero"),
        bad.alias("out_of_range"),
        kept.isNull().alias("missing"),
    )


def zero_vote_guard(score: Column, votes: Column, settings: Settings = DEFAULTS) -> Column:
    """A rating without votes is no rating. ``struct<rating, rating_zero, votes_zero>``."""
    ok = (F.coalesce(votes, F.lit(0.0)) != 0) & score.between(0, settings.rating_max)
    return F.struct(
        F.when(ok, score).alias("rating"),
        F.coalesce(score == 0, F.lit(False)).alias("rating_zero"),
        F.coalesce(votes == 0, F.lit(False)).alias("votes_zero"),
    )


def rating_range_guard(number: Column, settings: Settings = DEFAULTS) -> Column:
    return F.when(number.between(0, settings.rating_max), number)


def is_missing_text(value: Column) -> Column:
    return value.isNull() | F.lower(strip(value)).isin("", "nan", "none", "null", "[]")


def is_missing_number(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def is_missing_list(value: Column) -> Column:
    return value.isNull() | (F.size(value) == 0) | (value == F.array(F.lit("Unknown")))


def safe_bool(flag: Column, default: bool = False) -> Column:
    return F.coalesce(flag, F.lit(default))
