"""The pipeline's stages against what the operators say on their own, and its contract."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tickerloom.llm import bpe, contamination, pii, quality, similar

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def folder(spark, tmp_path, texts):
    rows = [(i, t, "en", "a", len(t or "")) for i, t in texts]
    by_id = dict(texts)
    rows += [(600, f"{by_id[9]} write to some.one@mail.example.org", "en", "a", 1)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, by_id[11]), (2, "nothing of this is there " * 5)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    return str(tmp_path)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 5
    judged = quality.judged(docs)
    want = {r["doc_id"] for r in judged.where("kept").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, before, folder)
        if k < 4:
            assert docs.schema.names == before.schema.names
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if k == 1:
            rows = similar.linked(before, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT).collect()
            want = {r["component_id"] for r in rows if r["n"]} | {r["doc_id"] for r in rows if not r["n"]}
        elif k == 2:
            bad = contamination.judged(before, benchmark).where("contaminated").collect()
            assert [r["doc_id"] for r in bad] == [11]
            want -= {11}
        elif k == 3:
            finder = pii.Finder()
            for r in docs.collect():
                assert not finder.find(r["text"] or "") and r["n_chars"] == len(r["text"] or "")
        assert ids == want
        docs = docs.cache()


def test_run_gives_the_ids_of_the_masked_texts(spark, folder):
    result = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    same = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    row = result[min(i for i in result if i in (9, 600))]
    text = same.decode(row["ids"])
    assert row["ids"] == same.encode_ordinary(text) and row["n_tokens"] == len(row["ids"])
    assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert 11 not in result and not {100, 101} & set(result)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
