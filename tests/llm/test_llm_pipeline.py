"""The pipeline's stages over the smallest tables, each against its own rule."""

import corpus_pipeline
from llm_fixtures import SMALL, documents, empty

from ticketlens.llm import exact_dedup, near_dedup, secret_links
from ticketlens.llm.scratch import Scratch


def test_stages_take_and_return_documents(spark, tmp_path):
    scratch = Scratch(spark, "test")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    said = docs.where("lang = 'en' AND n_chars > 2000").orderBy("doc_id").limit(1)
    said = said.selectExpr("doc_id + 900000 AS doc_id", "concat('password=abcdef123456 ', reverse(text)) AS text",
                           "lang", "source", "n_chars")
    docs = docs.unionByName(said)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, scratch.write(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        if name == "language_id":
            assert docs.count() == before.count()
        elif name == "exact_dedup":
            assert docs.count() == before.selectExpr("lower(text)").distinct().count()
            assert exact_dedup.find_exact(docs).where("NOT kept").count() == 0
        elif name == "minhash_near_dedup":
            assert docs.count() == near_dedup.link(before).where("kept").count()
            assert near_dedup.link(docs).where("NOT kept").count() == 0
        else:
            assert docs.count() == before.count()
            assert secret_links.find_secrets(docs).where("size(spans) > 0").count() == 0
            assert before.exceptAll(docs).count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.select("doc_id").distinct().count() == docs.count()
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.drop("sequence_id", "offset").exceptAll(last.drop("sequence_id", "offset")).isEmpty()
    assert whole.count() == last.count()


def test_stages_take_odd_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (documents(spark, 40), empty(spark)):
            found = stage(spark, docs, SMALL)
            assert found.count() <= 5 * docs.count(), name
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert found.columns == docs.columns
