import os
from hashlib import sha256

import corpus_pipeline
from termloom.llm import secretscan
from termloom.llm.jaccard import one_of_each
from termloom.llm.langid import accepted


def test_stages_match_plain_versions(spark, mixed_docs):
    d = mixed_docs.select("doc_id", "text", "lang", "source", "n_chars")
    columns, stages = d.columns, dict(corpus_pipeline.STAGES)
    first = stages["language_id"](spark, d, "")
    assert first.columns == columns
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in d.collect() if any(c.isalpha() for c in r.text or "")}
    second = stages["ngram_join"](spark, first, "")
    assert second.columns == columns and second.count() < first.count()
    third = stages["secret_scan"](spark, second, "")
    assert third.columns == columns and sorted(r.doc_id for r in third.collect()) == sorted(r.doc_id for r in second.collect())
    fourth = stages["mixing"](spark, third, "")
    assert fourth.columns == columns and {r.doc_id for r in fourth.collect()} == {r.doc_id for r in third.collect()}
    last = stages["byte_bpe"](spark, fourth, "").collect()
    hashes = {r.doc_id: sha256(r.text.encode()).hexdigest() for r in third.collect()}
    assert len(last) == fourth.count() and all(r.decoded_sha256 == hashes[r.doc_id] for r in last)


def test_secrets_leave_the_texts(spark):
    d = spark.createDataFrame([(1, "my token = 'abcdef123456' ok", "en", "s", 28)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.secret_scan(spark, d, "").first()
    assert "abcdef" not in out.text and out.n_chars == len(out.text) and not secretscan.scan(out.text)[0]


def test_empty_table(spark, empty):
    assert accepted(empty).count() == 0 and one_of_each(empty).count() == 0


def test_what_a_stage_has_read_goes(spark, mixed_docs, tmp_path, monkeypatch):
    mixed_docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    folders = []

    def noted(df, name, real=corpus_pipeline.materialise):
        out = real(df, name)
        folders.append(out.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
        return out

    monkeypatch.setattr(corpus_pipeline, "materialise", noted)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert [os.path.exists(f) for f in folders] == [False, False, False, True]
    assert out.count() > 0 and spark.read.parquet(f"{tmp_path}/documents.parquet").count() == mixed_docs.count()
