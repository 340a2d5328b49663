"""Truth tables of the column functions."""

import random

import pytest
from pyspark.sql import functions as F

from fusework.functions import indel, lists as L, parse as P, similarity as S, text as X


def column(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_runtime(spark):
    cases = {
        None: (None, "missing"), "": (None, "missing"), "nan": (None, "missing"),
        "Not-Released": (None, "not_released"),
        "$5,000,000": (None, "money_in_runtime"), "142 minutes (estimated)": (None, "money_in_runtime"),
        "1:45": (105.0, "parsed_hhmm"), "2 hours 27 minutes": (147.0, "parsed_text"), "2h27": (120.0, "parsed_text"),
        "142 min": (142.0, "parsed_text"), "5 min": (5.0, "parsed_text"), "3 months": (3.0, "parsed_text"),
        "0 min": (None, "too_small_probably_not_runtime"), "142": (142.0, "parsed_minutes"),
        "19": (None, "too_small_probably_not_runtime"), "7.8": (None, "too_small_probably_rating"),
        "123.5": (123.5, "parsed_numeric"), "about 2h": (None, "unparsed"), "1.5 hours": (None, "unparsed"),
        "1:45:00": (None, "unparsed"),
    }
    got = column(spark, list(cases), P.parse_runtime)
    assert [(r["minutes"], r["status"]) for r in got] == list(cases.values())


def test_money(spark):
    cases = {
        None: (None, False, "missing"), "": (None, False, "missing"), "None": (None, False, "missing"),
        "$1,234 (estimated)": (1234.0, False, "valid"), "0": (None, True, "zero_as_missing"),
        "$0": (None, True, "zero_as_missing"), "-5": (None, False, "negative_invalid"),
        "abc": (None, False, "unparsed"), "5d": (None, False, "unparsed"),
    }
    got = column(spark, list(cases), P.parse_money)
    assert [(r["value"], r["was_zero"], r["status"]) for r in got] == list(cases.values())


def test_counts(spark):
    cases = {"187K": 187000.0, "1.2M": 1.2e6, "2b": 2e9, "1,500": 1500.0, "12 k": 12000.0, "abc": None, "": None,
             "1.2.3": None}
    assert column(spark, list(cases), P.parse_count_suffix) == pytest.approx(list(cases.values()))


def test_numbers_and_years(spark):
    assert column(spark, ["5", " 5 ", "5d", "1e3", "-.5", "", None, "nan"], P.numeric_coerce) == [
        5.0, 5.0, None, 1000.0, -0.5, None, None, None]
    assert column(spark, ["-1999", "1899", "2026.9", "x", "99999999999999"], P.clean_year) == [
        1999, None, 2026, None, None]


def test_titles(spark):
    cases = {
        "The Matrix (1999)": "matrix", "Amélie": "amelie", "Tom & Jerry": "tom and jerry",
        "Blade Runner 2049": "blade runner", "1917": None, "The": "the", "The A Team": "a team", None: None,
        "\tThe  Matrix ": "matrix",
    }
    assert column(spark, list(cases), X.normalize_title) == list(cases.values())


def test_accents_follow_unicode(spark):
    import unicodedata

    samples = [chr(c) for c in list(range(0xC0, 0x250)) + list(range(0x370, 0x400)) + list(range(0x1E00, 0x1F00))]
    want = [
        "".join(p for p in unicodedata.normalize("NFD", s) if unicodedata.category(p) != "Mn") for s in samples
    ]
    assert column(spark, samples, X.strip_accents) == want
    assert column(spark, ["é"], X.strip_accents) == ["e"]


def test_title_case(spark):
    words = ["film-noir", "rock'n'roll", "WAR & politics"]
    assert column(spark, words, X.title_case) == [w.title() for w in words]


def test_genres(spark):
    cases = {
        "['Sci-Fi','sci fi']": ["Science Fiction"], "Film-Noir": ["Film-Noir"], "tv movie": ["TV Movie"],
        "biography": ["Biographical"], "[]": ["Unknown"], None: ["Unknown"], "Drama, Drama": ["Drama"],
    }
    assert column(spark, list(cases), lambda c: X.normalize_genres(L.parse_list_field(c))) == list(cases.values())


def test_lists(spark):
    cases = {
        "['a, b', 'c']": ["a, b", "c"], '["x"]': ["x"], "[1, 2.5]": ["1", "2.5"], r"['it\'s']": ["it's"],
        "[a; b|c]": ["a", "b", "c"], "('x')": ["x"], "": [], "null": [], "a,,b": ["a", "b"],
    }
    assert column(spark, list(cases), L.parse_list_field) == list(cases.values())
    assert column(spark, ["[a; b]", "['q']", "None"], L.ensure_list) == [["[a", "b]"], ["q"], []]


def test_score(spark):
    rows = [(100.0, 70.0, None, None), (100.0, 70.0, 100.0, 0.0), (100.0, 70.0, 0.0, 0.0), (None, None, None, None)]
    df = spark.createDataFrame(rows, "t double, y double, r double, g double")
    score = S.composite_linkage_score(*[F.col(c) for c in "tyrg"])
    got = df.select(score.alias("s"), S.classify_match(score).alias("c")).collect()
    assert [r["s"] and round(r["s"], 2) for r in got] == [91.18, 87.5, 77.5, None]
    assert [r["c"] for r in got] == ["strong_match", "probable_match", "manual_review", "no_match"]


def test_similarities(spark):
    df = spark.createDataFrame([(100.0, 105.0), (100.0, 160.0), (100.0, 130.0), (100.0, None)], "a double, b double")
    got = [r[0] for r in df.select(S.runtime_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [100.0, 0.0, 50.0, None]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain_token_set(a, b):
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    s, x, y = (" ".join(sorted(v)) for v in (ta & tb, ta - tb, tb - ta))
    if s and (not x or not y):
        return 100.0

    def ratio(p, q):
        return 200.0 * plain_lcs(p, q) / (len(p) + len(q))

    if not s:
        return ratio(x, y)
    sx, sy = f"{s} {x}", f"{s} {y}"
    whole = 100 * (1 - (len(x) + len(y) - 2 * plain_lcs(x, y)) / (len(sx) + len(sy)))
    return max(whole, ratio(s, sx), ratio(s, sy))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcdeé1") for _ in range(rng.randint(1, 8))) for _ in range(25)]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(120)]


def test_lcs_equals_brute_force_beyond_one_word(texts):
    other = texts[1:] + texts[:1]
    assert max(map(len, texts)) > 64
    want = [plain_lcs(a, b) for a, b in zip(texts, other)]
    assert indel.pairwise_lcs(texts, other, batch=50).tolist() == want


def test_token_set_block_and_columns_agree_with_brute_force(spark, texts):
    block = indel.TokenSetBlock(texts)
    for query in texts[:15]:
        want = [plain_token_set(t, query) for t in texts]
        assert block.scores(query).tolist() == pytest.approx(want)
    pairs = list(zip(texts, reversed(texts)))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(indel.token_set_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([plain_token_set(a, b) for a, b in pairs])
    none = spark.createDataFrame([(None, "x")], "a string, b string")
    assert none.select(indel.indel_ratio(F.col("a"), F.col("b"))).first()[0] is None


def test_percent_ties_round_up(spark):
    from fusework.functions.numbers import percent

    df = spark.createDataFrame([(85, 100_000)], "n bigint, total bigint")
    assert df.select(percent(F.col("n"), F.col("total"), 2)).first()[0] == 0.09
