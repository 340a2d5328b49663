"""Periodic runs, spelling variants and packing against brute force, and with odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fusework.llm import best_fit_packing, periodic_runs, spelling_variants
from fusework.llm.queries import QUERIES, tokenizer_path

ODD = [(1, None), (2, ""), (None, "one line of text here"), (3, "a b c\n\na b c"), (3, "a b c\n\na b c"), (4, "word " * 5000), (5, " \t\n"),
       (6, "x" * 60_000), (7, "x" * 60_000), (8, "a b " * 30 + "z " * 9)]


def plain_runs(w):
    """All maximal runs by their definition."""
    out = []
    for s in range(len(w)):
        for q in range(1, len(w) // 4 + 1):
            if s and s - 1 + q < len(w) and w[s - 1] == w[s - 1 + q]:
                continue
            e = s + q
            while e < len(w) and w[e] == w[e - q]:
                e += 1
            if e - s >= max(6, 4 * q) and all(any(w[k] != w[k + r] for k in range(s, e - r)) for r in range(1, q)):
                out.append((s, e - s, q))
    return out


def plain_periods(doc_id, words):
    """The words with the periods that the query plants."""
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_runs_by_brute_force():
    rng, total = random.Random(1), 0
    for _ in range(200):
        docs = []
        for _ in range(rng.randint(1, 6)):
            n = rng.randint(1, 70)
            w = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(n)]
            for _ in range(rng.randint(0, 3)):
                p, a = rng.randint(1, 6), rng.randrange(n)
                for i in range(a + p, min(n, a + rng.randint(3, 8) * p)):
                    w[i] = w[i - p]
            docs.append(w)
        lengths = np.array([len(d) for d in docs])
        starts = np.cumsum(lengths + 1) - lengths
        symbols = np.concatenate([[0], *[np.array([*d, 0]) for d in docs]])
        found = zip(*(x.tolist() for x in periodic_runs.find_runs(symbols, lengths, starts)))
        want = [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d)]
        assert sorted(found) == sorted(want)
        total += len(want)
    assert total > 300


def test_words_of_random_order_have_equal_hashes_nowhere():
    # the Thue-Morse words, on which polynomial hashes modulo powers of two fail, have no run
    word = [bin(k).count("1") % 2 + 1 for k in range(4096)]
    assert not len(periodic_runs.find_runs(np.array([0, *word, 0]), np.array([4096]), np.array([1]))[0])


def test_runs_query(spark, tmp_path):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["ab", "c", "Zé"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs += [x for x in ODD if x[0] != 4] + [(90, "w " * 400)]
    path = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("runs", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op11_periodic_runs"](spark, path).collect()), key=str)
    want = []
    for i, text in docs:
        w = plain_periods(i, [x.decode() for x in (text or "").encode().split()])
        runs = sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (
            "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(x for k, x in enumerate(w) if k not in gone))]
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests))
    assert got == sorted(want, key=str)
    assert sum(r[1] for r in want) > 40


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n):
    rows, forms = {}, {}
    for w in n:
        close = [v for v in n if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= 10 * n[w] else None
        rows[w] = (n[w], len(close), forms[w], n.get(forms[w]))
    ends = {}
    for w in n:
        end = w
        while forms[end]:
            end = forms[end]
        ends[w] = end
    return sorted((w, *rows[w], ends[w]) for w in n)


def test_variants_by_brute_force(spark):
    rng = random.Random(2)
    words = set()
    while len(words) < 500:
        w = [rng.choice("abéÿ") for _ in range(rng.randint(3, 9))]
        words.add("".join(w))
        w[rng.randrange(len(w))] = rng.choice("abc")
        words.add("".join(w))
    long = "".join(rng.choice("xyz") for _ in range(9000))
    words |= {long, long[:3000] + "q" + long[3001:], long[:8999], "a" * 4000, "a" * 4001}
    n = {w: rng.choice([2, 2, 3, 5, 30, 31, 400, 5000]) for w in sorted(words)}
    df = spark.createDataFrame(list(n.items()), "word string, n long").withColumn("uid", F.lit("clash"))
    rows = spelling_variants.group_variants(df).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, rows)) == plain_variants(n)


def test_a_hot_node(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "NODE_STATES", 7)
    rng = random.Random(3)
    n = {"prefixes" + "".join(rng.choices("abcd", k=4)): rng.choice([2, 30, 400]) for _ in range(150)}
    rows = spelling_variants.group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert sorted(map(tuple, rows.select("word", "n", "n_near", "form", "form_n", "root").collect())) == plain_variants(n)


def test_variants_query(spark, tmp_path):
    rng = random.Random(5)
    pool = ["".join(rng.choices("abcdefÉé×", k=rng.randint(6, 9))) for _ in range(60)]
    docs = [(i, " ".join(rng.choice(["Wonderful", "ABCDEFGH", *pool]) + rng.choice(["", ",", "1", "-x"]) for _ in range(200))) for i in range(60)]
    docs += [(None, "wonderful Wonderful wonderfu"), (90, None), (91, ""), (92, "ÀÉÿabcd ÀÉÿabcd àéÿabcd")]
    path = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    counts = {}
    import re
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    want = plain_variants({w: k for w, k in counts.items() if k >= 2})
    rows = QUERIES["op12_spelling_variants"](spark, path).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, rows)) == want and any(r[3] for r in want)


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling_variants.group_variants(empty).collect() == []
    one = spark.createDataFrame([("wonderful", 3), (None, 5), ("ab", 2)], "word string, n long")
    assert {(r.word, r.n_near, r.form, r.root) for r in spelling_variants.group_variants(one).collect()} == {
        ("wonderful", 0, None, "wonderful"), ("ab", 0, None, "ab")}
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    assert {r.run[:9] for r in spelling_variants.letter_runs(docs).collect()} == {"x" * 9}


def test_dual_functions_are_feasible():
    rng, capacity = random.Random(1), 24
    functions = list(best_fit_packing.dual_functions(capacity))
    for _ in range(2000):
        left, sizes = capacity, []
        while left and rng.random() < 0.95:
            sizes.append(rng.randint(1, left))
            left -= sizes[-1]
        assert all(values[sizes].sum() <= unit for values, unit in functions)


def fewest(sizes, capacity):
    """The optimum, by trying all ways."""
    best = [len(sizes)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= sizes[k]:
                rest = list(rooms)
                rest.remove(r)
                place(k + 1, [*rest, r - sizes[k]])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best[0]


def test_bounds_hold():
    rng, tight = random.Random(6), 0
    for _ in range(150):
        sizes = sorted((rng.randint(1, 24) for _ in range(rng.randint(1, 9))), reverse=True)
        optimum = fewest(sizes, 24)
        _, _, opened, count, bound = best_fit_packing.pack_group(np.array(sizes), 24)
        assert bound <= optimum <= count
        tight += bound == count
    assert tight > 120


@pytest.mark.parametrize("low, high, slack", [(1, 2048, 0.005), (700, 1100, 0), (1100, 1500, 0), (1, 300, 0.002)])
def test_packing(spark, low, high, slack):
    sizes = np.random.default_rng(1).integers(low, high + 1, 20_000)
    df = spark.createDataFrame([(i, int(v), "x") for i, v in enumerate(sizes)], "doc_id long, length long, uid string")
    rows = best_fit_packing.pack_pieces(df, group_pieces=2000).toPandas()
    assert sorted(rows.doc_id) == list(range(len(sizes))) and set(rows.uid) == {"x"}
    for _, sequence in rows.sort_values("offset").groupby("sequence_id"):
        ends = np.cumsum(sequence.length.values)
        assert (sequence.offset.values == ends - sequence.length.values).all() and ends[-1] <= 2048
    bound = best_fit_packing.Bounds.of(sizes, 2048)
    assert rows.sequence_id.nunique() <= -(-bound.numerator // bound.denominator) + slack * bound


def test_packing_query(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.no_truncation(), library.no_padding()
    rng = random.Random(1)
    alphabet = [chr(c) for c in range(32, 127)] + list("éßΣİñ漢字😀½٣\x1c　\n\t") + ["hahaha ", "the ", "'s ", "<|endoftext|>", "   "]
    docs = [*ODD, *((i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9000) if i % 9 == 0 else 40))) for i in range(100, 200))]
    path = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("length", F.lit(0)).write.parquet(f"{path}/documents.parquet")
    rows = QUERIES["op13_best_fit_packing"](spark, path).toPandas()
    want = []
    for i, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = list(range(len(ids), 0, -2048))[::-1]
        for k, (a, b) in enumerate(zip([0, *cuts], cuts)):
            want.append((-1 if i is None else i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    got = rows[["doc_id", "piece", "start", "length", "ids_crc32"]].fillna(-1).astype(int)
    assert sorted(map(tuple, got.values.tolist())) == sorted(want)
    for _, sequence in rows.sort_values("offset").groupby("sequence_id"):
        ends = np.cumsum(sequence.length.values)
        assert (sequence.offset.values == ends - sequence.length.values).all() and ends[-1] <= 2048
    assert rows.sequence_id.nunique() == -(-sum(r[3] for r in want) // 2048)


def test_packed_ids(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    pieces = best_fit_packing.cut_documents(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=True).collect()
    assert all(len(p.ids) == p.length and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in pieces)
    empty = spark.createDataFrame([], "doc_id long, text string")
    cut = best_fit_packing.cut_documents(empty, tokenizer_path("byte_bpe_50k.json"))
    assert best_fit_packing.pack_pieces(cut).collect() == []
    assert periodic_runs.periodic_runs(empty).collect() == [] and periodic_runs.periodic_runs(docs).count() == len(ODD)
