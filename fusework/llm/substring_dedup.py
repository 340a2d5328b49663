"""Substring deduplication by winnowed windows of words.

Every run of ``WINDOW`` words is hashed over its bytes; of each ``REACH`` consecutive windows the one with the
smallest hash is picked, and the first and last window of a text are picked too. What is picked depends on
the words there alone, so two texts that share a passage pick the same windows in it: a passage of
``WINDOW + REACH - 1`` words or more has one at least, wherever it stands and whatever stands around it.
Picked windows are compared by digest over all documents. Windows that overlap here as in the document
that keeps them are one passage, which is equal byte for byte there; passages can be cut out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fusework.llm.textbatch import bounded_batches, pieces, span_hashes, stored, word_spans

WINDOW = 16  # words compared as one, and of a reported passage: longer than a common line
REACH = 10  # windows of which one is picked
LEAST_WORDS = WINDOW
# Prefix sums take 8 bytes a byte, several times over, and idle workers keep what they once took.
TEXT_BYTES = 256 << 10
BATCH_BYTES = 2 << 20


def picked(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of the windows to compare; ``rows`` are sorted. Of equal hashes the last is picked.

    In text that repeats itself, picks that follow each other are equal: of these, the first of each half
    ``REACH`` is enough, as the digest stays and what is left still overlaps.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    take = np.ones(n, bool)
    take[1:] = rows[1:] != rows[:-1]
    take[:-1] |= rows[1:] != rows[:-1]
    take[-1] = True
    whole = np.flatnonzero(rows[: n - REACH + 1] == rows[REACH - 1 :]) if n >= REACH else np.zeros(0, np.int64)
    best = whole.copy()
    for k in range(1, REACH):
        best = np.where(hashes[whole + k] <= hashes[best], whole + k, best)
    chosen = np.zeros(n, bool)
    chosen[best] = True
    at = np.flatnonzero(chosen)
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (hashes[at[1:]] != hashes[at[:-1]]) | (rows[at[1:]] != rows[at[:-1]])
        block = (at - at[np.flatnonzero(new)[np.cumsum(new) - 1]]) // (REACH // 2)
        new[1:] |= block[1:] != block[:-1]
        take[at[new]] = True
    return np.flatnonzero(take)


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, uid, word (number of the first word), start, size (bytes), digest of every picked window.

    uid tells documents with one doc_id apart. Windows are compared byte for byte by a 64-bit digest,
    white space included. Texts of fewer than ``WINDOW`` words, and NULL, have none.
    """
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("uid"), "text")

    def work(batches):
        for batch, data, offsets in pieces(batches, size=TEXT_BYTES):
            starts, ends, row = word_spans(data, offsets)
            n = max(0, len(starts) - WINDOW + 1)
            at = np.flatnonzero(row[:n] == row[WINDOW - 1 :]) if n else np.zeros(0, np.int64)
            hashes = span_hashes(data, starts[at], ends[at + WINDOW - 1])
            pick = picked(hashes, row[at])
            at, hashes = at[pick], hashes[pick]
            owner, start = row[at], starts[at]
            word = at - np.searchsorted(row, owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), batch.column("uid").take(pa.array(owner)),
                 *[pa.array(v.astype(np.int32)) for v in (word, start - offsets[owner], ends[at + WINDOW - 1] - start)],
                 pa.array(hashes.view(np.int64))],
                ["doc_id", "uid", "word", "start", "size", "digest"],
            )

    return rows.mapInArrow(work, f"doc_id {key}, uid bigint, word int, start int, size int, digest bigint")


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row for each passage that stands in an earlier document, or earlier in the same one.

    doc_id, uid, start, size (bytes), word, n_words, kept_doc_id, kept_start. The first occurrence by
    (doc_id, uid, place), NULL ids first, is kept and gets no row. Rows equal in id and text are one document.
    Where parts of a passage stand first in different documents, each part is a row, and rows may overlap.
    """
    every = stored(windows(docs), "windows")
    common = every.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    hits = every.join(common, "digest")
    own = F.struct("doc_id", "uid", "word", "start")
    keepers = hits.groupBy("digest").agg(F.min(own).alias("kept"))
    again = hits.join(keepers, "digest").where(~F.col("kept").eqNullSafe(own)).select(
        "doc_id", "uid", "word", "start", "size",
        F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.uid").alias("kept_uid"), F.col("kept.start").alias("kept_start"),
        (F.col("kept.word") - F.col("word")).alias("apart"),
    )
    # windows that share a word, here as there, have one difference of numbers; repeated rows change no run
    same = ["doc_id", "uid", "kept_doc_id", "kept_uid", "apart"]
    lane = W.partitionBy(*same).orderBy("word")
    new = F.coalesce(F.col("word") - F.lag("word").over(lane) >= WINDOW, F.lit(True))
    runs = again.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(lane))
    return (
        runs.groupBy(*same, "run")
        .agg(
            F.min("start").alias("start"), (F.max(F.col("start") + F.col("size")) - F.min("start")).alias("size"),
            F.min("word").alias("word"), (F.max("word") - F.min("word") + WINDOW).cast("long").alias("n_words"),
            F.min("kept_start").alias("kept_start"),
        )
        .where(F.col("n_words") >= least_words)
        .select("doc_id", "uid", "start", "size", "word", "n_words", "kept_doc_id", "kept_start")
    )


def remove_repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``; every row and column stays. NULL stays NULL."""
    spans = repeated_passages(docs.select("doc_id", "text"), least_words)
    gone = spans.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("gone"))
    boxed = docs.select(F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("uid"))
    raw = F.col("raw")
    joined = boxed.join(gone, "uid", "left").withColumn("raw", F.col("doc.text").cast("binary"))
    state = F.aggregate(
        "gone", F.struct(F.lit(b"").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.concat(acc["out"], F.substring(raw, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))).alias("out"),
            F.greatest(acc["at"], s["start"] + s["size"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(raw, acc["at"] + 1, F.length(raw))).cast("string"),
    )
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(state)
    return joined.withColumn("text", text).select(*[F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])
