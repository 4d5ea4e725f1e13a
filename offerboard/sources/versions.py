"""A log of committed batches, for tables that several batches write and that readers see whole or not at all.

A batch writes its files under ``batch=<name>`` folders of the table. They
count only once its commit row exists, which is the last thing written: one
row in one file, so it appears by one rename. A batch that stops before has no
effect, and a retried one overwrites its own folders. A commit may name the
batches that it replaces (``compact``); they stop counting at the same moment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT = "name string, seq long, replaces array<string>, batch string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq, replaces) of every committed batch."""
    if not exists(spark, f"{path}/commits"):
        return spark.createDataFrame([], "name string, seq long, replaces array<string>")
    return spark.read.schema(COMMIT).parquet(f"{path}/commits").drop("batch")


def live_batches(spark: SparkSession, path: str) -> DataFrame:
    """(batch, seq) of the committed batches that no other one replaces."""
    done = commits(spark, path)
    gone = done.select(F.explode("replaces").alias("name")).distinct()
    return done.join(gone, "name", "left_anti").select(F.col("name").alias("batch"), "seq")


def commit(spark: SparkSession, path: str, batch: str, replaces=()) -> None:
    """Make ``batch`` count, after all before it; a batch that is committed again keeps its place."""
    row = commits(spark, path).agg(F.max(F.when(F.col("name") == batch, F.col("seq"))).alias("own"), F.max("seq").alias("top")).first()
    seq = row.own if row.own is not None else (row.top + 1 if row.top is not None else 0)
    names = F.array(*[F.lit(r) for r in replaces]).cast("array<string>")
    one = spark.range(1).select(F.lit(batch).alias("name"), F.lit(seq).cast("long").alias("seq"), names.alias("replaces"))
    one.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch={batch}")


def read_batches(spark: SparkSession, path: str, part: str, text_columns=("batch",)) -> DataFrame:
    """All files of one part of the table, with its folder columns as text (``2024-01`` is no number)."""
    from pyspark.sql.types import StringType, StructField, StructType
    found = spark.read.parquet(f"{path}/{part}").schema
    schema = StructType([StructField(f.name, StringType()) if f.name in text_columns else f for f in found])
    return spark.read.schema(schema).parquet(f"{path}/{part}")
