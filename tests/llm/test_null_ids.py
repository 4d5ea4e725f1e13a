"""Documents without an id in the mix."""
from pyspark.sql import functions as F

import corpus_pipeline as P
from offerboard.llm import mixing
from offerboard.llm.common import settle


def test_mix_keeps_rows_without_id(spark):
    settle(spark)
    rows = [(None if i % 3 else i, " ".join(f"w{i % 50}x{k}" for k in range(5 + i % 90)), f"s{i % 3}", 0) for i in range(200)]
    rows += [(None, None, "s0", 0), (None, "", "s1", 0), (7, "a b c", None, 0), (None, "a b c", None, 0), (None, "a b c", None, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    m = mixing.mix_sources(d)
    count = F.coalesce(F.sum(F.regexp_count("text", F.lit(mixing.WORD))), F.lit(0))
    mixed = mixing.mixed_documents(d, m)
    for some in (F.col("doc_id").isNull(), F.col("doc_id").isNotNull()):
        taken = m.documents.where(some).agg(F.sum("taken")).first()[0]
        assert taken > 0 and mixed.where(some).agg(count).first()[0] == taken
    assert P.mix(spark, d, "").agg(count).first()[0] == m.documents.agg(F.sum("taken")).first()[0]
