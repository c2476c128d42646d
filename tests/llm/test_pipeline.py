"""The pipeline's stages against brute force, and its edge cases."""

from __future__ import annotations

import re
import zlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests_llm_brute import brute_base, brute_components, brute_contamination, brute_simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    state = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = state.orderBy("doc_id").collect()
        state = stage(spark, state, SF)
        assert state.columns == docs.columns and state.dtypes == docs.dtypes
        after = {r.doc_id: r for r in state.collect()}
        assert len(after) == state.count()
        if name == "language":
            want = {r.doc_id for r in before if re.search(r"[^\W\d_]", r.text or "")}
        elif name == "near_duplicates":
            roots = brute_components([r.doc_id for r in before], [brute_simhash(r.text) for r in before])
            want = set(roots)
        elif name == "decontamination":
            judged = brute_contamination([(r.doc_id, r.text) for r in before], items)
            want = {d for d, v in judged.items() if not v[4]}
            assert len(want) < len(before)
        else:
            want = {r.doc_id for r in before}
            assert any(brute_base(r.text) for r in before)
            assert not any(brute_base(r.text) for r in after.values())
            assert all(r.n_chars == len(r.text) for r in after.values())
            assert all(after[r.doc_id].text == r.text for r in before if not brute_base(r.text) and "REDACTED" not in after[r.doc_id].text)
        assert set(after) == want, name
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in state.collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    ids = {d: tokenizer.encode(t, add_special_tokens=False).ids + [1] for d, t in texts.items()}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert list(r.token_ids) == part and r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))


def test_stages_on_odd_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "same words here today", "en", None, None), (1, "same words here today", "en", None, None),
         (2, "", "en", "s", 0), (3, "SAME words here today", None, "s", 5), (None, "unlike text of its own, quite other", "en", "s", None)],
        docs.schema,
    ).withColumn("fingerprint", F.lit("clash")).withColumn("found", F.lit(1)).withColumn("k", F.lit(2))
    state = docs.limit(30).select(*docs.columns, F.lit("x").alias("fingerprint"), F.lit(0).alias("found"), F.lit(0).alias("k"))
    state = state.filter("doc_id > 3").union(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, SF)
        assert state.columns == odd.columns
        if name == "near_duplicates":
            same = [r for r in state.collect() if (r.text or "").lower() == "same words here today"]
            assert [r.doc_id for r in same] == [1]
    assert corpus_pipeline.STAGES[-1][1](spark, state, SF).count() > 0
    state = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, SF)
        assert state.count() == 0


def test_rows_without_an_id_of_their_own_are_judged_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    item = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if r.text), key=lambda t: len(t.split()))
    plain = ["the quiet river ran past old mills", "seven grey geese crossed a frozen field", "bakers rise early in every town"]
    rows = [(i, t, lang, None, None) for i in (None, 9) for t, lang in [(plain[0], "en"), (plain[1], None), (plain[2], None), (item, None)]]
    rows += [(None, "12 34", "en", None, None), (9, "-- 5", None, None, None), (None, plain[1], None, "again", None)]
    texts = lambda df: sorted((r.doc_id is None, r.text) for r in df.collect())
    state = spark.createDataFrame(rows, docs.schema).repartition(3)
    lettered = sorted((r[0] is None, r[1]) for r in rows if r[1] not in ("12 34", "-- 5"))
    assert texts(corpus_pipeline.language(spark, state, SF)) == lettered
    unlabelled = state.withColumn("lang", F.lit(None).cast("string"))
    assert texts(corpus_pipeline.language(spark, unlabelled, SF)) == lettered
    clean = [t for t in lettered if t[1] != item]
    assert texts(corpus_pipeline.decontamination(spark, state.filter("text like '%a%' or text like '%e%'"), SF)) == clean
    # copies under a null id give way to those with one; without any id, one row of each text stays
    assert texts(corpus_pipeline.near_duplicates(spark, state.filter("text rlike '[a-z]'"), SF)) == sorted((False, t) for t in [*plain, item])
    none = state.filter("doc_id is null and text rlike '[a-z]'")
    assert texts(corpus_pipeline.near_duplicates(spark, none.union(none), SF)) == sorted((True, t) for t in [*plain, item])
