"""Registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    decontaminate, html, jaccard, langid, negatives, packing, periodic, secrets, simhash, sketch, suffixes, token_counts, warc,
)
from tillstar.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; wrappers inferred from each host's pages."""
    return html.extract(table(spark, sf_dir, "pages"))


def op2_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written to ZIP-packaged archives and read back by range."""
    rows = warc.roundtrip(table(spark, sf_dir, "pages"), payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def sample_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with three edits each: cut out of the first half, a phrase in the middle, more at the end."""
    n = F.length(F.coalesce("text", F.lit("")))
    edit = lambda at, remove, insert: F.struct(
        at.cast("int").alias("start"), F.lit(remove).alias("remove"), insert.alias("insert")
    )
    head = F.substring(F.coalesce("text", F.lit("")), 1, 40)
    return docs.withColumn(
        "edits",
        F.array(
            edit(n / 4, 16, F.lit("")),
            edit(n / 2, 5, head),
            edit(n, 0, F.concat(F.lit("\nedit of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))),
        ),
    )


def op3_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after edits, encoded anew only around them."""
    return token_counts.edited_counts(sample_edits(table(spark, sf_dir, "documents")), tokenizer_path(), added=True)


def op4_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), added=True)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, weak candidates linked with their other parts."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and its component of links at 2 bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, budget=2)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in an occurrence of a benchmark window."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more of every document that occur elsewhere too."""
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op9_document_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every document and its edited form, and likenesses."""
    return sketch.edit_report(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives of each of five positives of every fiftieth vector."""
    vec_id, label = F.col("vec_id"), F.col("label").cast("bigint")
    return negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"),
        anchor=vec_id % 50 == 0,
        label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label),
    )


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their five-word shingles."""
    return jaccard.similarity_components(table(spark, sf_dir, "documents"), k=5, percent=80)


def planted_repeat(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of a tenth of the documents (by a checksum of the id), from some word on a repeat of the following ones."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of four periods and six words or more in every document, some with a planted repeat."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), min_periods=4, min_length=6, edit=planted_repeat)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_warc_archives, op3_edit_token_counts, op4_sequence_packing, op5_secret_scan,
        op6_simhash_neardup, op7_decontamination, op8_repeated_passages, op9_document_sketches, op10_language_id,
        op11_hard_negatives, op12_jaccard_join, op13_periodic_runs, pipeline,
    )
}
