"""The corpus operators against brute force, SQL, exact round trips and held-out labels."""

import glob
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import rows_of
from fusework.llm import bpe, html_extract, language_id, line_dedup, mixing, near_duplicates, quality_classifier, quality_rules, substring_dedup, vector_search
from fusework.llm.queries import QUERIES, SQL, tokenizer_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "one line of text here", "en", None, 5), (3, "a b c\n\na b c", "de", "s", 9),
       (3, "a b c\n\na b c", "de", "s", 9), (4, "word " * 4000, "en", "t", 20000)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, sf_dir)
    result = db.execute(SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    lang = QUERIES["op6_language_id"](spark, folder).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (lang.lang == lang.lang_pred).mean() > 0.97
    quality = QUERIES["op2_quality_classifier"](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    assert (quality.quality == quality.predicted).mean() > 0.97


def test_edit_distance(spark):
    rng, rows = random.Random(3), []
    for _ in range(200):
        a = [rng.choice("abé😀") for _ in range(rng.randint(1, 14))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b)), rng.choice("abc")) if rng.random() < 0.6 else b.pop(rng.randrange(len(b))) if len(b) > 1 else None
        a, b = sorted(("".join(a), "".join(b)), key=len)
        if len(b) - len(a) <= 2:
            rows.append((a, b, levenshtein(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int")
    for r in df.withColumn("e", line_dedup.edit_distance(F.split("a", ""), F.split("b", ""))).collect():
        assert r.e == r.d if r.d <= 2 else r.e > 2


def test_lines_by_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(3, 40))) for _ in range(12)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice("xyz")
            lines.append("".join(line))
        docs.append((i, "\n".join(lines)))
    docs += [(None, "hello world this is a line"), (100, None), (101, ""), docs[5]]
    found = line_dedup.removed_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no, r.edits) for r in found.collect()}
    places = sorted(
        (((i is not None, i or 0), k, i, line) for i, t in set(docs) if t for k, line in enumerate(t.split("\n")) if line.strip()),
        key=lambda p: p[:2],
    )
    first = {}
    for p in places:
        first.setdefault(p[3], p)
    want = {}
    for p in places:
        line, near = p[3], []
        for other, f in first.items():
            if f[:2] < first[line][:2] and min(len(line), len(other)) >= 20 and levenshtein(line, other) <= 2:
                near.append((f[0], f[1], f[2], levenshtein(line, other)))
        if near:
            x = min(near, key=lambda n: n[:2])
            want[p[2], p[1]] = (x[2], x[1], x[3])
        elif first[line] != p:
            want[p[2], p[1]] = (first[line][2], first[line][1], 0)
    assert got == want and want


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(8)
    vocabulary, texts = [f"w{i}" for i in range(300)], []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 60, 150, 300]))]
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    docs = list(enumerate([*texts, "", None, "   ", "a b", "a b", texts[0]]))
    found = near_duplicates.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r.doc_id: (r.class_id, r.rep_id, r.n_links) for r in found.collect()}

    def shingles(text):
        w = (text or "").split()
        return frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))

    sets = {i: shingles(t) for i, t in docs}
    rep = {i: min(j for j in sets if sets[j] == sets[i]) if sets[i] else i for i in sets}
    reps = {i for i in sets if rep[i] == i and sets[i]}
    links = {i: {j for j in reps if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in reps}
    root = {i: i for i in sets}
    for _ in sets:
        for i in reps:
            for j in links[i]:
                root[i] = root[j] = min(root[i], root[j])
    assert got == {i: (root[rep[i]], rep[i], len(links.get(rep[i], ()))) for i in sets}
    assert any(links.values())


def test_tokens_equal_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    library, mine, rng = Tokenizer.from_file(path), bpe.load_automaton(path), random.Random(1)
    library.no_truncation(), library.no_padding()
    alphabet = [chr(c) for c in range(32, 127)] + list("éßΣσςİñ漢字かな😀½٣́\x1c\x85　\n\t") + ["hahaha", "the ", "'s ", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(2000)] + ["", "a" * 300, "!" * 90]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = mine.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids
        assert mine.decode(ids).decode() == library.decode(want.ids, skip_special_tokens=False)


def test_long_words_take_time_in_proportion():
    import time

    from tokenizers import Tokenizer

    path = tokenizer_path()
    library, mine, rng = Tokenizer.from_file(path), bpe.load_automaton(path), random.Random(1)
    library.no_truncation(), library.no_padding()
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(1 << 20))
    for text in ("a" * (1 << 20), letters, "漢字" * 100_000):
        start = time.process_time()
        ids = mine.encode(text)
        assert time.process_time() - start < 15
        want = library.encode(text[:60_000], add_special_tokens=False).ids
        # a word's end changes its last tokens alone
        assert np.frombuffer(mine.encode(text[:60_000]), "<u4").tolist() == want
        assert np.frombuffer(ids, "<u4")[: len(want) - 20].tolist() == want[:-20]


def test_passages_survive_insertions(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    docs, passages = [], [" ".join(word() for _ in range(80)) for _ in range(20)]
    for i, passage in enumerate(passages):
        docs.append((i, " ".join(word() for _ in range(50)) + " " + passage))
        docs.append((100 + i, " ".join(word() for _ in range(rng.randint(1, 90))) + " " + passage + " " + word()))
    docs += [(200 + i, " ".join(word() for _ in range(200))) for i in range(20)]
    df = spark.createDataFrame([*docs, (None, None), (300, "")], "doc_id long, text string")
    rows = substring_dedup.repeated_passages(df).collect()
    assert {r.doc_id for r in rows} == {100 + i for i in range(20)}
    left = {r.doc_id: r.text for r in substring_dedup.remove_repeated_passages(df).collect()}
    assert all(left[i] == t for i, t in docs if not 100 <= i < 200) and all(len(left[100 + i]) < 700 for i in range(20))


def test_pages():
    model = html_extract.train(list(html_extract.PAGES))
    text = "words of a text that is long enough. " * 8
    page = (f"<nav><a href=/>Home</a></nav><div class=ad><p>Buy now</p></div><article><h1>T &amp;\n t</h1><p>{text}<p>Short</article>"
            "<div class=comments><p>A reader says this and that.</p></div><script>x</script><footer>End</footer>")
    assert html_extract.extract(page, model) == f"T & t\n{text.strip()}\nShort"
    assert html_extract.extract("", model) == "" and html_extract.extract("Only text, no tags", model) == "Only text, no tags"


def test_mix_reaches_targets(spark):
    rows = [(i, f"s{i % 4}" if i % 9 else None, i % 57) for i in range(3000)]
    df = spark.createDataFrame(rows, "key long, source string, size long")
    mixed = mixing.mix_sources(df)
    first = sorted(mixed.collect())
    assert first == sorted(mixing.mix_sources(df.repartition(7)).collect()) and len(first) == len(rows)
    assert max(r.copies for r in first) <= 2
    for source in {r.source for r in first}:
        mine = [r for r in first if r.source == source]
        assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) <= 57


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, DOC).withColumn("key", F.lit("x")).withColumn("uid", F.lit(1))
    n = len(rows)
    model = language_id.fit_language_model(docs)
    assert language_id.identify_languages(docs, model).count() == n
    assert bpe.encode_documents(docs, tokenizer_path()).count() == n
    assert quality_rules.apply_rules(docs).count() == n
    assert line_dedup.dedup_lines(docs).columns == docs.columns and line_dedup.dedup_lines(docs).count() == n
    assert near_duplicates.drop_near_duplicates(docs).columns == docs.columns
    assert mixing.mix_documents(docs).columns == docs.columns
    assert substring_dedup.remove_repeated_passages(docs).count() == n


def plain_line_key(line):
    import regex

    letters = regex.sub(r"[^\p{L}]+", " ", line).strip(" ").lower()
    return letters or line.strip(" ")


def test_furniture_lines_by_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    sentence = lambda n: " ".join(word() for _ in range(n))
    docs = []
    for host, n in (("tiny", 4), ("small", 30), ("middle", 700), ("large", 3000), (None, 50)):
        menu = [sentence(9) for _ in range(8)]
        for i in range(n):
            # a few documents have little but the host's lines, some a line or two of them, and numbers stand in all
            own = [sentence(12) for _ in range(1 if i % 10 == 0 else 6)]
            some = menu if i % 10 == 0 else rng.sample(menu, rng.randint(0, 2))
            lines = [*(f"{rng.choice(['*', '-'])} {x.upper() if rng.random() < 0.5 else x} {i}" for x in some), *own, f"{i} | {i % 7}", "3 | 14"]
            rng.shuffle(lines)
            docs.append((len(docs), "\n".join(lines), host))
    docs += [(90_000, None, "small"), (90_001, "", "small"), docs[0], (None, docs[1][1], "tiny")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("found", F.lit("clash"))
    got = sorted(((r.doc_id, r.n_removed_words, r.kept) for r in quality_rules.apply_rules(df).collect()), key=str)
    held, hosts = {}, {}
    for _, text, host in docs:
        hosts[host] = hosts.get(host, 0) + 1
        for key in {plain_line_key(x) for x in (text or "").split("\n") if x.split()}:
            held[host, key] = held.get((host, key), 0) + 1
    want = []
    for i, text, host in docs:
        n, gone = len((text or "").split()), 0
        for line in (text or "").split("\n"):
            if line.split() and held[host, plain_line_key(line)] > max(0.01 * hosts[host], min(20, 0.05 * hosts[host]), 2):
                gone += len(line.split())
        want.append((i, gone, n >= 20 and n - gone >= 0.3 * n))
    assert got == sorted(want, key=str)
    rejected = [w for w in want if w[1] and not w[2]]
    assert len(rejected) > 300 and sum(w[2] for w in want) > 3000
    # the table of numbers keeps the rows that stand in no other document
    assert max(w[1] for w in want) <= 8 * 11 + 3


def test_equal_rows_take_turns(spark):
    rows = [(1, "same text", "s")] * 900 + [(i, f"text {i} of its own", "s") for i in range(2, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(9)
    out = mixing.mix_documents(docs).groupBy("doc_id").count().collect()
    copies = {r.key: r.copies for r in mixing.mix_sources(docs.select(F.col("doc_id").alias("key"), "source", F.lit(3).cast("long").alias("size"))).groupBy("key").agg(F.sum("copies").alias("copies")).collect()}
    found = {r.doc_id: r["count"] for r in out}
    assert abs(found[1] - copies[1]) <= 40 and max(found[i] for i in found if i > 1) <= 2


def test_sums_beyond_64_bits(spark):
    big = 2_000_000_000
    rows = [([big + i % 3 + k for k in range(len(quality_classifier.NAMES))], i % 2) for i in range(20)]
    model = quality_classifier.fit_discriminant(spark.createDataFrame(rows, "x array<bigint>, label int"))
    assert len(model.means) == 2 and np.isfinite(model.offsets).all()


def test_search_with_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)] + [(300, None), (350, [1.0, None]), (400, [float("nan")]), (450, [])]
    rows += [(500 + i, [1e15] * 8) for i in range(3)]
    found = vector_search.top_k(vector_search.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), 3, 50).collect()
    vectors = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if v is not None and all(x is not None and x == x for x in v)}
    for q in [i for i in vectors if i % 50 == 0]:
        clip = lambda s: max(1 - (1 << 63), min((1 << 63) - 1, s))
        best = sorted((-clip(sum(a * b for a, b in zip(vectors[q], v))), i) for i, v in vectors.items() if i != q)[:3]
        assert [(-r.score, r.vec_id) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == best


def test_one_document_of_each_group_of_copies_reaches_the_mix(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    docs, group = [], {}
    for g in range(12):
        lines = [[word() for _ in range(12)] for _ in range(12)]
        for k in range(15):
            mine = [list(x) for x in lines]
            if g % 2:  # near copies: a line or two with two other words, which line dedup leaves
                for line in rng.sample(mine, k % 3):
                    line[rng.randrange(12)] = word() + word()
            i = 100 * k + g
            group[i] = g
            docs.append((i, "\n".join(" ".join(x) for x in mine), "en", f"s{g % 3}", 0))
    lone = [(9000 + i, "\n".join(" ".join(word() for _ in range(12)) for _ in range(5)), "en", "s1", 0) for i in range(5)]
    df = spark.createDataFrame([*docs, *lone, (9900, None, None, None, None)], DOC)
    out = corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.drop_repeated_lines(spark, df, ""), "")
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [*range(12), *[r[0] for r in lone], 9900]


def test_passages_with_common_chunks(spark):
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(5000)]
    common = [" ".join(rng.choices(pool, k=rng.randint(3, 7))) for _ in range(20)]
    words = lambda n: " ".join(rng.choices(pool, k=n))
    docs, size = [(i, f"{words(30)} {c} {words(30)}") for i, c in enumerate(common)], {}
    for i in range(300):
        n = rng.randint(51, 60)
        passage = words(n).split()
        for _ in range(3):
            at = rng.randrange(n - 7)
            piece = rng.choice(common).split()
            passage[at : at + len(piece)] = piece
        size[2000 + i] = n
        for k in (1000 + i, 2000 + i):
            docs.append((k, " ".join([words(rng.randint(1, 80)), *passage, words(rng.randint(1, 80))])))
    rows = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    text = {k: t.encode() for k, t in docs}
    covered = {k: set() for k in size}
    for r in rows:
        assert text[r.doc_id][r.start : r.start + r.size] == text[r.kept_doc_id][r.kept_start : r.kept_start + r.size]
        assert len(text[r.doc_id][r.start : r.start + r.size].split()) == r.n_words >= 16
        covered[r.doc_id] |= set(range(r.word, r.word + r.n_words))
    assert all(len(covered[k]) >= n - 2 * (substring_dedup.REACH - 1) for k, n in size.items())


def test_languages_of_many_letters(spark):
    rng = random.Random(6)
    han = [chr(0x4E00 + 7 * i) for i in range(900)]
    pools = {
        "ru": ["".join(rng.choices("абвгдежзийклмнопрстуфхцчшщыьэюя", k=rng.randint(2, 9))) for _ in range(300)],
        "el": ["".join(rng.choices("αβγδεζηθικλμνξοπρστυφχψω", k=rng.randint(2, 9))) for _ in range(300)],
        "en": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(300)],
        "zh": ["".join(rng.choices(han[:500], k=2)) for _ in range(300)],
        "yue": ["".join(rng.choices(han[400:], k=2)) for _ in range(300)],
    }
    docs = [(100 * k + i, " ".join(rng.choices(pool, k=150)), lang) for k, (lang, pool) in enumerate(pools.items()) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.fit_language_model(df.where("doc_id % 100 < 40"))
    assert len(model.letters) > 700
    rows = language_id.identify_languages(df.where("doc_id % 100 >= 40").drop("lang"), model).collect()
    names = list(pools)
    assert len(rows) == 100 and all(r.lang_pred == names[r.doc_id // 100] and r.score > 0.5 for r in rows)
    # phrases as in a parse by plain search
    text = docs[-1][1][:256]
    codes = model.codes[[ord(c) for c in text]]
    found = language_id.parse(model, codes, np.array([0, len(codes)]))[:, 0]
    sample = "".join(sample_of(df, "yue"))
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    assert found[model.languages.index("yue")] == count


def sample_of(df, lang):
    rows = df.where((F.col("lang") == lang) & (F.col("doc_id") % 100 < 40)).orderBy(F.xxhash64("doc_id", "text"), "doc_id").collect()
    out, size = [], 0
    for r in rows:
        size += len(r.text)
        if size > language_id.SAMPLE_CHARS:
            break
        out.append(r.text)
    return out


def test_samples_are_whole_texts(spark):
    short = [(40 + i, f"kurz und gut {'abcdefgh'[i]} " * 30, "de", "s", 0) for i in range(8)]
    long = [(20 + i, f"sehr langer text {i} " * 9000, "de", "s", 0) for i in range(3)]
    only = [(30, "un texte tout seul " * 9000 + "fin", "fr", "s", 0)]
    docs = spark.createDataFrame([*short, *long, *only, *ODD], DOC).withColumn("size", F.lit("clash")).withColumn("owner", F.lit(0))
    model = language_id.fit_language_model(docs)
    assert model.languages == ["de", "en", "fr"]
    # a language takes texts that fit together, and a longer one only where it has no other
    assert [round(2**b) for b in model.bits][2] == len(only[0][1]) and 2 ** model.bits[0] < language_id.SAMPLE_CHARS
    kept = language_id.keep_identified(docs, model, 0.25)
    assert kept.columns == docs.columns
    found = {r.doc_id: r.lang_pred for r in language_id.identify_languages(docs.select("doc_id", "text"), model).collect()}
    everything = [tuple(r) for r in docs.collect()]
    want = [r for r in everything if found[r[0]] != "und"]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str) and len(want) == len(everything) - 2


def test_displaced_rows():
    rng = random.Random(2)
    for span in (4, 40, 900):
        codes = [rng.randrange(1, span) for _ in range(3000)]
        states = language_id.suffix_automaton(codes)
        base, owner, to = language_id.displaced(states, span)
        assert len(owner) < 1.5 * (sum(map(len, states)) + 4 * span)
        for state in range(0, len(states), 13):
            for c in range(span):
                place, end = base[state] + c, states[state].get(c)
                assert (owner[place] == state) == (end is not None) and (end is None or to[place] == end)


def test_pages_with_text_in_the_training_mark(spark):
    rows = [(1, "u", '<p data-content="some text">Words of a page.</p>'), (2, "u", '<p data-content="">Words of a page.</p>'),
            (3, "u", "<p data-content>Words of a page.</p>"), (4, "u", "<p>Words of a page.</p>")]
    found = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len({r.text for r in found}) == 1 and len(found) == 4
