"""What keeps the corpus operators within their limits of time and memory."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fusework.llm import line_dedup, near_duplicates, substring_dedup, vector_search
from fusework.llm.textbatch import perhaps_in, pieces


@pytest.fixture
def no_adaptive(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the final plan is known before it runs
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_keys_of_lines_are_compiled(spark, no_adaptive):
    # HotSpot compiles no method of over 8,000 bytes
    lines = spark.createDataFrame([("a line of some length", 21)], "line string, n int")
    _, probes = line_dedup._keys(line_dedup.EDITS)
    keyed = line_dedup._cuts(lines, line_dedup.EDITS).select(F.explode(F.array(*probes)).alias("key"))
    parts = keyed.groupBy("key").count()._jdf.queryExecution().debug().codegenToSeq()
    assert parts.size() and max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_cuts_of_lines(spark, edits):
    rows = spark.createDataFrame([(k,) for k in range(edits, 40)], "n int")
    places = [line_dedup._place(F.col("size0"), F.col("longer0"), i, edits) for i in range(edits + 1)]
    for r in line_dedup._cuts(rows, edits).select("n", F.array(*[F.struct(*p) for p in places]).alias("p")).collect():
        assert [tuple(x) for x in r.p] == line_dedup.segment_places(r.n, edits)


def test_windows_are_cut_in_small_pieces(spark):
    rows = pa.table({"text": ["word " * 20_000, None, "x" * 1_000_000, *["some words " * 900] * 200]})
    texts, rest = [], rows["text"].to_pylist()
    for batch, data, offsets in pieces(rows.to_batches(), size=substring_dedup.TEXT_BYTES):
        assert len(data) <= substring_dedup.TEXT_BYTES or batch.num_rows == 1
        texts += [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:])]
    assert texts == [t or "" for t in rest]
    # workers get no more text at a time than these pieces need
    substring_dedup.windows(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 2 << 20


def test_both_texts_of_a_document_are_joined_in_the_same_stages(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(8):
        base = words[40 * g : 40 * g + 40]
        rows += [(100 * k + g, " ".join(base if k % 2 else [*base[:-1], f"x{k}"]), " ".join(base[: 5 + 5 * (k % 3)])) for k in range(6)]
    rows += [(7000, None, "one two three four five six"), (7001, "", "one two three four five six"), (None, "a b", "a b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, whole_text string")
    texts = [df.select(F.lit(k).alias("side"), "doc_id", F.col(c).alias("text")) for k, c in enumerate(("text", "whole_text"))]
    alone = {(k, *r) for k, t in enumerate(texts) for r in near_duplicates.near_duplicate_classes(t.drop("side")).collect()}
    both = near_duplicates.near_duplicate_classes(texts[0].union(texts[1]), by=["side"])
    assert both.columns == ["side", "doc_id", "class_id", "rep_id", "n_links"] and {tuple(r) for r in both.collect()} == alone

    names, stored = [], near_duplicates.stored
    monkeypatch.setattr(near_duplicates, "stored", lambda t, name: names.append(name) or stored(t, name))
    kept = near_duplicates.drop_near_duplicates(df, whole="whole_text")
    smallest = [{d for side, d, c, *_ in alone if side == k and d == c} for k in (0, 1)]
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(smallest[0] & smallest[1])
    assert kept.where("doc_id IS NULL").count() == 1
    assert all(names.count(x) == 1 for x in ("sketches", "members", "groups", "links"))


def test_rounds_of_components_end_with_stars(spark, monkeypatch):
    names, stored = [], near_duplicates.stored
    monkeypatch.setattr(near_duplicates, "stored", lambda t, name: names.append(name) or stored(t, name))
    stars = [(k, k % 5) for k in range(5, 60)]
    path = [(k, k + 1) for k in range(100, 112)]
    for edges, rounds in ((stars, 0), (path, None), ([], 0)):
        names.clear()
        got = dict(near_duplicates.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
        assert got == {x: 100 if x >= 100 else x % 5 for e in edges for x in e}
        assert rounds is None or names == ["edges"]


def test_bitmaps_lose_no_row_and_doubt_few(spark):
    ids = spark.range(0, 30_000, 10).union(spark.range(5)).selectExpr("id", "id % 2 AS side").union(spark.createDataFrame([(None, 1)], "id bigint, side bigint"))
    rows = spark.range(30_000).crossJoin(spark.range(2).withColumnRenamed("id", "side")).withColumn("text", F.lit("t"))
    told = perhaps_in(rows, ids, ["side", "id"], 3005)
    assert told.columns == ["id", "side", "text", "perhaps"] and told.count() == 60_000
    assert told.join(ids, ["id", "side"], "left_semi").where("NOT perhaps").count() == 0
    assert told.where("perhaps").count() < 3005 + 60_000 / 12
    assert perhaps_in(rows, ids.where("false"), ["side", "id"], 0).where("perhaps").count() == 0
    # fewer bitmaps than rows would need: more doubt, no loss
    few = perhaps_in(spark.range(100_000), spark.range(100_000), ["id"], 10)
    assert few.where("NOT perhaps").count() == 0


def test_texts_that_stay_are_not_shuffled(spark, no_adaptive):
    rows = [(k, f"only text {k} of words that no other has{k}", f"whole {k} a{k} b{k} c{k}") for k in range(40)]
    rows += [(100 + k, "the same seven words for all copies", "the same seven words for all copies") for k in range(5)]
    df = spark.createDataFrame(rows * 2 + [(None, "x", "y")], "doc_id bigint, text string, whole_text string")
    kept = near_duplicates.drop_near_duplicates(df, whole="whole_text")
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted([*range(40), 100] * 2)
    assert kept.where("doc_id IS NULL").count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # the texts come twice: those in doubt through a join, the others as they are
    assert "Union" in plan and plan.count("getbit") >= 2 and "LeftAnti" in plan


def test_queries_of_a_search_are_broadcast_in_bounded_rounds(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    df = vector_search.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = sorted(map(tuple, vector_search.top_k(df, 3, 5).collect()))
    v = np.floor(256 * np.array([x for _, x in rows])).astype(np.int64)
    scores = v @ v.T
    for q, rank, i, score in want:
        best = sorted((-scores[q, j], j) for j in range(400) if j != q)
        assert (-score, i) == best[rank - 1]
    assert len(want) == 80 * 3
    for name, size in (("SEGMENT", 40), ("BATCH", 8), ("ROUND_BYTES", 2000)):
        monkeypatch.setattr(vector_search, name, size)
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or broadcast(self, value))
    assert sorted(map(tuple, vector_search.top_k(df, 3, 5).collect())) == want
    # every query is sent once, however many segments it meets
    size = [sum(len(r["queries"]) + len(r["query_ids"]) + len(r["floor"]) for r in s) for s in sent]
    assert len(sent) >= 3 and all(n <= 2000 or len(s) == 1 for n, s in zip(size, sent))
    assert sum(size) == 80 * 8 * 8
    assert vector_search.top_k(df.where("false"), 3, 5).count() == 0
