"""Redaction of documents: the same texts as the spans of ``find_pii`` give, for rows of every kind."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from offerboard.llm import pii
from offerboard.llm.common import settle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, spans int"


@pytest.fixture(scope="module")
def s(spark):
    return settle(spark)


def test_equals_the_spans_of_find_pii(s):
    lead = "please write to {} for help"
    rows = [(i, lead.format(f"user{i}@mail.example.org"), "en", "a", 0, "clash", 1) for i in range(8)]
    rows += [(20, lead.format("someone at mail dot example dot org"), None, None, None, None, None), (21, None, None, None, None, None, None),
             (22, "", "en", "a", 0, "x", 1), (23, "nothing here", "en", "a", 12, "x", 1), (None, lead.format("n@x.org"), "en", "a", 9, "x", 1),
             (1, lead.format("user1@mail.example.org"), "en", "a", 0, "clash", 1), (1, "other 10.0.0.1 text", "en", "a", 0, "clash", 1)]
    docs = s.createDataFrame(rows, SCHEMA)
    got = pii.redact_documents(docs, length_col="n_chars")
    assert got.columns == docs.columns and got.count() == len(rows)
    spans = pii.find_pii(docs).dropDuplicates(["doc_id", "mark"]).select(F.col("doc_id").alias("k"), "mark", F.col("spans").alias("found"))
    marked = docs.withColumn("m", F.xxhash64(F.coalesce("text", F.lit(""))))
    want = marked.join(spans, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("m") == F.col("mark")), "left") \
        .select("doc_id", pii.redacted(F.col("text"), F.col("found")).alias("text"))
    key = lambda df: sorted((str(r.doc_id), str(r.text)) for r in df.collect())
    assert key(got.select("doc_id", "text")) == key(want)
    assert got.where("n_chars <> length(text)").count() == 0 and got.where("text like '%@%'").count() == 0
    assert P.redact(s, docs.limit(0), "").count() == 0
