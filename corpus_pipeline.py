"""A corpus pipeline over ``documents``: each stage calls one operator of ``tillstar.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  Each stage's result is written as Parquet to the shared
folder and read back as the next one's input.  All but the last return the
columns of ``documents``.

Decisions are made by row: rows with a null doc_id or one shared with other texts
stand for documents of their own.

1. language: documents without a language (no letters) or whose best language
   scores below ``MIN_LANGUAGE_SCORE`` go; where no row has a label to learn from,
   only those without letters.
2. near duplicates: of each SimHash component the document with the smallest
   doc_id stays (one of them, where rows repeat).
3. decontamination: documents contaminated by the benchmark go.
4. secrets: every span found is replaced by a mark; n_chars follows.
5. packing: the pieces of all kept documents in sequences, with their ids.

The first and third stage judge and pass each row in one reading of the table; the
second shuffles the texts once, for the join with the kept rows' places; the fourth
shuffles those texts that a first look finds something in.  Plans do not depend on sizes.

Null and empty texts have no letters and go in the first stage (called alone, the others
keep them: two such texts are near duplicates, none is contaminated or holds a secret, and each is packed as the
end mark alone).  Ties are settled by the smallest doc_id, then text hash, then place.  Texts of any length are read whole.
Empty tables pass through every stage; extra columns, whatever their names, are passed on by all but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import decontaminate, langid, packing, secrets, simhash
from tillstar.llm.common import table, written
from tillstar.llm.queries import tokenizer_path

MIN_LANGUAGE_SCORE = 0.05


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a recognised language, or with letters where no row has a label."""
    return langid.recognised(docs, langid.fit(docs), MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component: one with its smallest doc_id."""
    return simhash.deduplicated(docs, shingle=3, budget=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with at least a twentieth of their words in benchmark windows."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts; no document goes."""
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids, with the ids."""
    return packing.pack(docs, tokenizer_path(), with_ids=True, added=True)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Language scores and tokenizer ids are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
