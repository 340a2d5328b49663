"""The registered queries of this subpackage, each with SQL where SQL can express it (else None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fusework.llm import (
    best_fit_packing, bpe, html_extract, language_id, line_dedup, mixing, near_duplicates, periodic_runs, quality_classifier,
    quality_rules, spelling_variants, substring_dedup, vector_search,
)
from fusework.llm.sql import OP1_SQL, OP4_SQL, OP10_SQL
from fusework.llm.textbatch import stored, word_count, words_column


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every vector whose id is divisible by 50, against all other vectors."""
    return vector_search.top_k(vector_search.scaled(table(spark, sf_dir, "embeddings")), k=5, every=50)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of a third of the ids are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = language_id.bucket(F.col("doc_id"), 3) == 1
    x = stored(quality_classifier.document_statistics(docs).withColumn("held_out", held), "statistics")
    train = x.where("NOT held_out").join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id").select("x", "label")
    model = quality_classifier.fit_discriminant(train)
    return quality_classifier.score_documents(x, model).select("doc_id", "held_out", "score", "predicted")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that stand in an earlier place too; the first occurrence has no row."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("uid")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and cross-document line frequency of all documents; the source is the host."""
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that are, up to two edits, an earlier line."""
    return line_dedup.removed_lines(table(spark, sf_dir, "documents")).drop("uid")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a fifth of the ids is held out of the labelled text."""
    docs = table(spark, sf_dir, "documents")
    held = language_id.bucket(F.col("doc_id"), 5) == 0
    model = language_id.fit_language_model(docs.where(~held))
    return language_id.identify_languages(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the tokens of every document, and of the text decoded from them."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return near_duplicates.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(docs.select(F.col("doc_id").alias("key"), "source", word_count(F.col("text")).alias("size")))
    return mixed.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text, where a tenth of the texts, by a hash of doc_id, repeat some of their words. A NULL id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    start, period = F.expr("g % n"), F.expr("1 + floor((n - g % n) / (3 + g % 8))")
    turned = F.transform("words", lambda w, i: F.when(i < start, w).otherwise(F.get("words", (start + (i - start) % period).cast("int"))))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("hit"))
    rows = rows.withColumn("words", F.when(F.col("hit"), words_column(F.col("text")))).withColumn("n", F.size("words"))
    return rows.select("doc_id", F.when(F.col("hit") & (F.col("n") > 0), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every document, the greatest of them, and digests of all runs and of the collapsed text."""
    found = periodic_runs.periodic_runs(planted_periods(table(spark, sf_dir, "documents")))
    # runs stand by start and period, and only a greater exponent displaces one
    best = F.reduce(
        F.expr("slice(runs, 2, greatest(size(runs) - 1, 0))"), F.get("runs", 0),
        lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent spelling, near words and root of every word of all documents; every 31st run, by a hash, loses a letter."""
    runs = spelling_variants.letter_runs(table(spark, sf_dir, "documents"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    cut = F.expr("concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))")
    words = runs.withColumn("h", h).select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelling_variants.group_variants(spelling_variants.count_words(words))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens that hold all documents."""
    pieces = best_fit_packing.cut_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return best_fit_packing.pack_pieces(pieces)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_top_k, op2_quality_classifier, op3_substring_dedup, op4_quality_rules, op5_line_dedup, op6_language_id, op7_bpe,
        op8_html_extraction, op9_jaccard_join, op10_mixing, op11_periodic_runs, op12_spelling_variants, op13_best_fit_packing,
    )
}

SQL: dict[str, str | None] = {"op1_exact_top_k": OP1_SQL, "op4_quality_rules": OP4_SQL, "op10_mixing": OP10_SQL}
