"""Quality rules with cross-document line frequency, in DataFrame operations only.

A line that stands in many documents of one host is furniture of the host and not writing. Lines are
normalised and hashed, the documents of each host that hold a line are counted, lines above the host's
limit are taken away, and documents of which too little is left are rejected.

A host's limit is a share of its documents: ``SMALL_SHARE`` of a small host's, two documents in any case, and ``SHARE`` of a
large one's, with ``MIDDLE`` documents where one goes over into the other. As a line must be in ``SHARE`` of a host's
documents, a host has at most ``1 / SHARE`` times its mean number of lines per document of them: that list travels
to the documents, not the documents' lines to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fusework.llm.textbatch import WORD, words_column

SHARE = 0.01  # of a large host's documents
SMALL_SHARE = 0.05  # of a small host's
MIDDLE = 20  # documents: the limit between 20 / SMALL_SHARE and 20 / SHARE documents
LEAST_DOCS = 2  # in any case more documents than this
LEFT = 0.3  # of a document's words that must remain

# Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30


def windows(words: Column) -> Column:
    """64-bit hashes of all runs of ``WINDOW`` words of an array, in order."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    n, span = F.size(words), 1
    while span < WINDOW:
        n = n - span
        # doubling: a run of 2 s words is a run of s words and the run s words later
        hashes = F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, span + 1, n), lambda x, y: F.xxhash64(x, y))
        span *= 2
    return F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def base_measures(docs: DataFrame) -> DataFrame:
    """Adds to ``docs``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), lines.

    ``lines`` are the lines with a word. A NULL text is an empty one. Windows are compared by 64-bit hashes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.withColumns({"words": words_column(F.col("text")), "lines": lines, "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long")})
    rows = rows.select(
        *docs.columns, "lines", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows(F.col("words")).alias("runs"),
    )
    # only texts with a repeated run are looked at more closely
    repeats = F.size(F.array_distinct("runs")) < F.size("runs")
    ordered = F.array_sort(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(repeats, ordered)).drop("runs")
    twice = F.filter(
        "ordered", lambda x, k: x["h"].eqNullSafe(F.get("ordered", k - 1)["h"]) | x["h"].eqNullSafe(F.get("ordered", k + 1)["h"])
    )
    rows = rows.withColumn("places", F.array_sort(F.transform(twice, lambda x: x["i"]))).drop("ordered")
    covered = F.aggregate(
        "places", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).cast("long").alias("n"), (i + WINDOW).alias("end")
        ),
        lambda acc: acc["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


def line_key(line: Column) -> Column:
    """Hash of a normalised line: lower case, everything but letters as one space; a line without letters as it is."""
    letters = F.lower(F.trim(F.regexp_replace(line, r"[^\p{L}]+", " ")))
    return F.xxhash64(F.when(letters == "", F.trim(line)).otherwise(letters))


def line_limit(docs: Column, share: float = SHARE) -> Column:
    """In more documents than this of a host with ``docs`` documents a line is furniture."""
    return F.greatest(share * docs, F.least(F.lit(MIDDLE), SMALL_SHARE * docs), F.lit(LEAST_DOCS))


def frequent_lines(docs: DataFrame, host: str = "source", share: float = SHARE) -> DataFrame:
    """host, frequent: for each host the hashes of its lines above the limit.

    A row is a document; a NULL host is a host of its own.
    """
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    keys = docs.select(F.col(host).alias("host"), F.explode(F.array_distinct(F.transform(lines, line_key))).alias("key"))
    held = keys.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LEAST_DOCS)
    sizes = docs.groupBy(F.col(host).alias("of")).agg(F.count(F.lit(1)).alias("docs"))
    above = held.join(sizes, F.col("host").eqNullSafe(F.col("of"))).where(F.col("n") > line_limit(F.col("docs"), share))
    return above.groupBy("host").agg(F.collect_list("key").alias("frequent"))


def apply_rules(docs: DataFrame, host: str = "source", share: float = SHARE, left: float = LEFT) -> DataFrame:
    """The base measures, base_failed, n_removed_words and kept for each row of ``docs``.

    ``docs`` has doc_id, text and the host column; others are left out. Empty and NULL texts fail the base.
    """
    above = frequent_lines(docs, host, share).withColumnRenamed("host", "of")
    rows = base_measures(docs.select("doc_id", F.col(host).alias("host"), "text"))
    rows = rows.withColumn("held", F.transform("lines", lambda x: F.struct(line_key(x).alias("key"), F.regexp_count(x, F.lit(WORD)).alias("n")))).drop("lines", "text")
    joined = rows.join(above, F.col("host").eqNullSafe(F.col("of")), "left")
    found = F.array_intersect(F.transform("held", lambda x: x["key"]), F.coalesce("frequent", F.array().cast("array<bigint>")))
    joined = joined.withColumn("found", found)
    removed = F.aggregate(
        F.filter("held", lambda x: F.array_contains(F.col("found"), x["key"])), F.lit(0).cast("long"), lambda acc, x: acc + x["n"]
    )
    removed = F.when(F.size("found") > 0, removed).otherwise(F.lit(0).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        removed.alias("n_removed_words"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed_words") >= left * F.col("n_words")))
