"""Registered queries of the training-data operators: each applies one operator to its whole table.

Signature of a query: ``(spark, sf_dir) -> DataFrame``. The queries derive the
contract's columns from what the operators return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, language, mixing, neighbours, packing, pieces, pii, quality, setjoin, tokens, vectors, whitening
from .common import table
from .htmltext import extract_text


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = language.held_out("doc_id")
    model = language.fit(docs.where(~fold))
    return language.language_mixtures(docs, model).select(
        "doc_id", fold.alias("held_out"), "lang_pred", "score", "shares")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, threshold, _ = quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "log_weight",
                         F.coalesce(F.col("key") >= threshold, F.lit(False)).alias("kept"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).documents.drop("row")


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(table(spark, sf_dir, "embeddings"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.link_documents(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
                        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pieces.decode(pieces.encode(table(spark, sf_dir, "documents")))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_language, op2_token_counts, op3_packing, op4_nearest, op5_quality, op6_html_text, op7_mixing,
    op8_near_vectors, op9_jaccard_join, op10_pii, op11_whitening, op12_divergence, op13_pieces)}

# exact shares over all kept terms of a language, each pair of sources joined by term
DIVERGENCE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
words AS (SELECT row_id, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT g.lang, g.source, coalesce(t.total, 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) g
           LEFT JOIN (SELECT c.lang, c.source, sum(c.n) AS total FROM counts c JOIN kept k ON k.lang = c.lang AND k.term = c.term
                      GROUP BY c.lang, c.source) t ON t.lang = g.lang AND t.source = g.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                  1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v)::HUGEINT AS p,
                  1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v)::HUGEINT AS q
           FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
           LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
         GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
          FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) x
QUALIFY part = 'pair' OR rank <= 200
"""

ORACLE: dict[str, str] = {"op12_divergence": DIVERGENCE_SQL}
