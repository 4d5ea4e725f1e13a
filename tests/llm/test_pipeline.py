"""The stages of corpus_pipeline.py: each works on what its predecessor kept."""
from pyspark.sql import functions as F

import corpus_pipeline as P
from offerboard.llm.common import settle, stored, table

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path))
    settle(spark)
    docs = table(spark, SMALL, "documents")
    kept = stored(P.keep_quality(spark, docs, SMALL), "t1")
    assert kept.columns == docs.columns and 0.6 * docs.count() < kept.count() <= docs.count()
    single = stored(P.drop_near_copies(spark, kept, SMALL), "t2")
    assert single.columns == docs.columns and single.count() < kept.count()
    assert single.select("doc_id").distinct().count() == single.count()
    clean = stored(P.redact(spark, single, SMALL), "t3")
    assert clean.count() == single.count() and clean.columns == docs.columns
    assert clean.where(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z0-9]")).count() == 0
    mixed = stored(P.mix(spark, clean, SMALL), "t4")
    assert mixed.columns == docs.columns and mixed.where(F.length("text") != F.col("n_chars")).count() == 0
    pieces = P.pack(spark, mixed, SMALL)
    assert pieces.groupBy("row_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).where("n <> d").count() == 0
    assert pieces.select("row_id").distinct().count() == mixed.count()
