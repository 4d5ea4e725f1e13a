"""Rows that share an id in the pipeline's near copy stage."""
from collections import Counter

import corpus_pipeline as P
from offerboard.llm.common import settle

TEXT = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcd"}
NEAR = TEXT["a"] + " more"


def test_unlinked_texts_of_one_id_stay(spark):
    settle(spark)
    rows = [(9, TEXT["a"]), (9, TEXT["b"]), (9, TEXT["b"]), (9, None), (9, None), (5, NEAR), (5, TEXT["c"]), (3, TEXT["d"]), (4, TEXT["d"]), (None, TEXT["d"])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in P.drop_near_copies(spark, d, "").collect())
    assert got == Counter([(5, NEAR), (9, TEXT["b"]), (9, None), (5, TEXT["c"]), (3, TEXT["d"]), (None, TEXT["d"])])


def test_copies_of_one_id_are_one(spark):
    settle(spark)
    d = spark.createDataFrame([(1, TEXT["a"]), (1, TEXT["a"]), (2, NEAR), (3, ""), (3, ""), (None, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in P.drop_near_copies(spark, d, "").collect())
    assert got == Counter([(1, TEXT["a"]), (3, ""), (None, None)])
