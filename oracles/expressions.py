"""DuckDB expressions for the column functions, written from their definitions."""

from __future__ import annotations

from fusework.config import CSV_NA_VALUES, GENRE_MAP

NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
ITEM = r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[+-]?\d+(?:\.\d+)?|None|True|False)"""
LIST = rf"\[\s*{ITEM}(\s*,\s*{ITEM})*\s*,?\s*\]"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def among(*texts: str) -> str:
    return "(" + ", ".join(q(t) for t in texts) + ")"


def number(x: str) -> str:
    t = f"trim(cast({x} AS varchar))"
    return f"(CASE WHEN regexp_full_match({t}, {q(NUMBER)}) THEN try_cast({t} AS double) END)"


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def basic_text(x: str) -> str:
    return "nullif(" + collapse(rf"regexp_replace(strip_accents(lower({x})), '[^a-z0-9\s]', ' ', 'g')") + ", '')"


def title_key(x: str) -> str:
    k = f"strip_accents(lower({x}))"
    k = rf"regexp_replace({k}, '\(\s*\d{{4}}\s*\)', ' ', 'g')"
    k = rf"regexp_replace({k}, '\b\d{{4}}\b', ' ', 'g')"
    k = f"replace({k}, '&', ' and ')"
    k = collapse(rf"regexp_replace({k}, '[^a-z0-9\s]', ' ', 'g')")
    return rf"nullif(regexp_replace({k}, '^(the|a|an)\s+', ''), '')"


def _unquoted(i: str) -> str:
    body = rf"regexp_replace(substr({i}, 2, length({i}) - 2), '\\(.)', '\1', 'g')"
    return f"trim(CASE WHEN {i}[1] IN ('''', '\"') THEN {body} ELSE {i} END)"


def _peeled(i: str) -> str:
    return f"""trim(trim(trim({i}), ''''), '"')"""


def parsed_list(x: str, brackets: bool = True) -> str:
    raw = f"trim({x})"
    bare = f"trim({raw}, '[]()')" if brackets else raw
    piece = _peeled("pi") if brackets else "trim(pi)"
    literal = f"list_transform(regexp_extract_all({raw}, {q(ITEM)}), lambda li: {_unquoted('li')})"
    if brackets:
        literal = f"list_filter({literal}, lambda lf: lf <> '')"
    return (
        f"(CASE WHEN {raw} IS NULL OR {raw} IN ('', '[]', 'nan', 'None', 'null') THEN []::varchar[] "
        f"WHEN regexp_full_match({raw}, {q(LIST)}) THEN {literal} "
        f"ELSE list_filter(list_transform(regexp_split_to_array({bare}, '[,;|]'), lambda pi: {piece}), "
        f"lambda pf: pf <> '') END)"
    )


def title_case(x: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({x}, '\p{{L}}+|\P{{L}}+'), "
        rf"lambda tc: upper(tc[1]) || lower(tc[2:])), '')"
    )


def genre(x: str) -> str:
    key = collapse(rf"regexp_replace(lower(strip_accents(trim({x}))), '[^a-z0-9\s\-]', ' ', 'g')")
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in GENRE_MAP.items())
    return f"(CASE {key} {cases} ELSE {title_case(f'trim({x})')} END)"


def ordered_distinct(x: str) -> str:
    return f"list_filter({x}, lambda od, oi: list_position({x}, od) = oi)"


def or_unknown(x: str) -> str:
    return f"(CASE WHEN len({x}) = 0 THEN ['Unknown'] ELSE {x} END)"


def genre_set(x: str) -> str:
    low = f"list_transform({x}, lambda gs: lower(trim(gs)))"
    return f"list_sort(list_distinct(list_filter({low}, lambda gf: gf NOT IN ('', 'unknown'))))"


def money_amount(x: str) -> str:
    return number(f"regexp_replace(regexp_replace(trim({x}), '\\(.*?\\)', '', 'g'), '[$,]', '', 'g')")


def money_status(x: str) -> str:
    a = money_amount(x)
    return (
        f"(CASE WHEN {x} IS NULL OR trim({x}) IN ('', 'nan', 'None', 'null') THEN 'missing' "
        f"WHEN {a} = 0 THEN 'zero_as_missing' WHEN {a} < 0 THEN 'negative_invalid' "
        f"WHEN {a} > 0 THEN 'valid' ELSE 'unparsed' END)"
    )


def money_value(x: str) -> str:
    return f"(CASE WHEN {money_amount(x)} > 0 THEN {money_amount(x)} END)"


_WORDS = r"^(?:(\d+)\s*(?:hours?|hrs?|hr|h))?\s*(?:(\d+)\s*(?:minutes?|mins?|min|m))?"


def _runtime_parts(x: str) -> tuple[str, str, str, str, str]:
    r = f"lower(trim({x}))"

    def grab(pattern: str, group: int) -> str:
        return f"try_cast(nullif(regexp_extract({r}, {q(pattern)}, {group}), '') AS double)"

    clock = f"({grab(r'^(\d{1,3}):(\d{2})$', 1)} * 60 + {grab(r'^(\d{1,3}):(\d{2})$', 2)})"
    words = f"(coalesce({grab(_WORDS, 1)}, 0) * 60 + coalesce({grab(_WORDS, 2)}, 0))"
    alone = grab(r"^(\d+)\s*(?:minutes?|mins?|min|m)?$", 1)
    return r, clock, words, alone, number(r)


def runtime_status(x: str) -> str:
    r, clock, words, alone, num = _runtime_parts(x)
    return (
        f"(CASE WHEN {r} IS NULL OR {r} IN ('', 'nan', 'none', 'null') THEN 'missing' "
        f"WHEN {r} LIKE '%not-released%' OR {r} LIKE '%not released%' THEN 'not_released' "
        f"WHEN {r} LIKE '%$%' OR {r} LIKE '%estimated%' THEN 'money_in_runtime' "
        f"WHEN {clock} IS NOT NULL THEN 'parsed_hhmm' WHEN {words} > 0 THEN 'parsed_text' "
        f"WHEN {alone} < 20 THEN 'too_small_probably_not_runtime' "
        f"WHEN {alone} IS NOT NULL THEN 'parsed_minutes' "
        f"WHEN {num} < 20 THEN 'too_small_probably_rating' "
        f"WHEN {num} IS NOT NULL THEN 'parsed_numeric' ELSE 'unparsed' END)"
    )


def runtime_minutes(x: str) -> str:
    _, clock, words, alone, num = _runtime_parts(x)
    return (
        f"(CASE {runtime_status(x)} WHEN 'parsed_hhmm' THEN {clock} WHEN 'parsed_text' THEN {words} "
        f"WHEN 'parsed_minutes' THEN {alone} WHEN 'parsed_numeric' THEN {num} END)"
    )


def count_suffix(x: str) -> str:
    r = f"replace(upper(trim({x})), ',', '')"
    unit = rf"regexp_extract({r}, '^([\d.]+)\s*([KMB]?)$', 2)"
    value = number(rf"regexp_extract({r}, '^([\d.]+)\s*([KMB]?)$', 1)")
    return f"({value} * CASE {unit} WHEN 'K' THEN 1000.0 WHEN 'M' THEN 1000000.0 WHEN 'B' THEN 1000000000.0 ELSE 1.0 END)"


def date(x: str) -> str:
    return f"cast(try_strptime(trim({x}), '%Y-%m-%d') AS date)"


def decade(year: str) -> str:
    return f"cast(floor({year} / 10) * 10 AS integer)"


def missing_text(x: str) -> str:
    return f"({x} IS NULL OR lower(trim({x})) IN ('', 'nan', 'none', 'null', '[]'))"


def runtime_sim(a: str, b: str) -> str:
    d = f"abs({a} - {b})"
    return f"(CASE WHEN {d} <= 5 THEN 100.0::double WHEN {d} >= 60 THEN 0.0::double WHEN {d} IS NOT NULL THEN 100.0::double * (1.0::double - {d} / 60.0::double) END)"


def year_sim(a: str, b: str) -> str:
    d = f"abs({a} - {b})"
    return f"(CASE WHEN {d} IS NULL THEN NULL WHEN {d} = 0 THEN 100.0 WHEN {d} = 1 THEN 70.0 WHEN {d} = 2 THEN 30.0 ELSE 0.0 END)::double"


def genre_sim(a: str, b: str) -> str:
    shared = f"len(list_intersect({a}, {b}))"
    return (
        f"(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN "
        f"100.0::double * {shared} / (len({a}) + len({b}) - {shared}) END)"
    )


def score(title: str, year: str, runtime: str, genres: str) -> str:
    parts = [("0.6", title), ("0.25", year), ("0.1", runtime), ("0.05", genres)]
    total = " + ".join(f"(CASE WHEN {v} IS NULL THEN 0 ELSE {w} END)::double" for w, v in parts)
    value = " + ".join(f"coalesce({w}::double * {v}, 0::double)" for w, v in parts)
    return f"(({value}) / nullif({total}, 0))"


def status(s: str) -> str:
    return (
        f"(CASE WHEN {s} >= 90 THEN 'strong_match' WHEN {s} >= 82 THEN 'probable_match' "
        f"WHEN {s} >= 75 THEN 'manual_review' ELSE 'no_match' END)"
    )


def lcs(x: str, y: str) -> str:
    """Longest common subsequence of two texts of at most 120 characters."""
    full = f"((1::hugeint << length({x})) - 1)"
    mask = (
        f"list_sum(list_transform(range(length({x})), lambda ma: CASE WHEN {x}[(ma + 1)] = ch "
        f"THEN (1::hugeint << ma) ELSE 0::hugeint END))::hugeint"
    )
    masks = f"list_transform(string_split({y}, ''), lambda ch: {mask})"
    left = (
        f"list_reduce(list_prepend({full}, {masks}), "
        f"lambda st, m: ((st + (st & m)) | (st - (st & m))) & {full})"
    )
    return f"(CASE WHEN length({x}) = 0 OR length({y}) = 0 THEN 0 ELSE length({x}) - bit_count({left}) END)"


def ratio(x: str, y: str) -> str:
    return (
        f"(CASE WHEN length({x}) + length({y}) = 0 THEN 100.0::double "
        f"ELSE 200.0::double * {lcs(x, y)} / (length({x}) + length({y})) END)"
    )


def tokens(x: str) -> str:
    return rf"list_sort(list_filter(regexp_split_to_array({x}, '\s+'), lambda tk: tk <> ''))"


def na_to_null(x: str) -> str:
    return f"(CASE WHEN cast({x} AS varchar) IN {among(*CSV_NA_VALUES)} THEN NULL ELSE cast({x} AS varchar) END)"
