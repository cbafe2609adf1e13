"""Each stage of the pipeline on odd rows and on its own brute-force or property check."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def test_stages_on_odd_rows(spark, odd_docs, tmp_path):
    docs, names = odd_docs, odd_docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        assert out.columns == names or i == len(corpus_pipeline.STAGES) - 1
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert {"doc_id", "tokens", "start"} <= set(docs.columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs.limit(0), SMALL).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 100 and rows.selectExpr("sum(n_tokens)").first()[0] > 10_000


def test_texts_are_sent_to_the_scorer_once(spark, odd_docs, monkeypatch):
    """Other columns may be called like helpers; those named as the added ones come back as they were."""
    sent = []
    real = corpus_pipeline.toxicity.score_toxicity
    monkeypatch.setattr(corpus_pipeline.toxicity, "score_toxicity", lambda docs, model: sent.append(docs) or real(docs, model))
    docs = odd_docs.withColumnsRenamed({"source": "score", "size": "a.b"}).withColumn("predicted", F.lit(7))
    out = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    assert Counter(map(str, out.collect())) - Counter(map(str, docs.collect())) == Counter() and out.count() > 0
    assert sent[0].columns == ["_doc", "text"] and "text" not in sent[0].schema["_doc"].dataType.names
