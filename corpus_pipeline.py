"""Training-corpus pipeline: documents to packed sequences, one operator a stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerboard.llm import mixing, packing, pii, quality, setjoin
from offerboard.llm.common import settle, stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    settle(spark)
    _, threshold, ratios = quality.resample(docs, table(spark, sf_dir, "labels"))
    return quality.selected(docs, ratios, threshold)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group linked by the n-gram Jaccard join.

    Documents without an id stay. Rows that share an id and a text are one
    document; rows that share an id and differ in text are documents of their
    own, which the join tells apart by a key made here.
    """
    settle(spark)
    own = docs.columns
    mark = F.coalesce(F.xxhash64("text"), F.lit(0))
    named = docs.where("doc_id is not null")
    shared = named.groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low < high")
    if shared.head(1):
        keyed = stored(named.select(F.struct(*own).alias("doc"), F.monotonically_increasing_id().alias("key")), "keyed")
        links = setjoin.link_documents(keyed.select("key", "doc.text"), "key").withColumnRenamed("key", "linked")
        marked = keyed.select("key", F.col("doc.doc_id").alias("id"), F.coalesce(F.xxhash64("doc.text"), F.lit(0)).alias("mark"))
        # texts without words are linked with nothing: of those, rows of one id and text are a group
        kept = (marked.join(links, F.col("key") == F.col("linked"))
                .groupBy(*[F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group"),
                           *[F.when(F.col("n_shingles") == 0, F.col(c)).alias("of_" + c) for c in ("id", "mark")]])
                .agg(F.min(F.struct("id", "mark", "key")).alias("first")).select(F.col("first.key").alias("kept_key")))
    else:
        keyed = named.select(F.struct(*own).alias("doc"), F.col("doc_id").alias("key"))
        kept = setjoin.link_documents(docs).where("doc_id = component_id").select(F.col("doc_id").alias("kept_key")).distinct()
    rows = keyed.withColumn("mark", F.xxhash64(*[F.col("doc")[c] for c in own]))
    first = (rows.join(stored(kept, "kept"), F.col("key") == F.col("kept_key"), "left_semi")
             .withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("mark"))).where("nth = 1"))
    return first.select("doc.*").unionByName(docs.where("doc_id is null"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every personal identifier replaced by its kind; n_chars follows the text."""
    settle(spark)
    return pii.redact_documents(docs, length_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix of sources takes them: a row for each pass over a document."""
    settle(spark)
    return mixing.mixed_documents(docs, mixing.mix_sources(docs), length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    settle(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", redact),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

ORACLE_SQL = None     # hashed models, tokens and permutations are beyond SQL; tests hold the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
