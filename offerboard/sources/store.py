"""The offers store as versions: each batch adds whole weeks, a manifest says which version of a week counts.

Overwriting the partitions of a week in place leaves readers with a mixture,
or with nothing, if the driver is lost between two of them. Here a batch only
adds files, under its own name; its manifest lists the (location, week) keys
it brought and their runs, and its commit makes all of them count at once. The
version of a key that counts is the one of the latest run, so a run that
arrives late changes nothing, without a read before the write; of equal runs
the batch committed last counts. A week that a run has emptied counts with no
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerboard.functions.text import run_order
from offerboard.operators.incremental import latest_per_week
from offerboard.sources import versions

KEYS = ["location", "file_week"]


def write_batch(offers: DataFrame, path: str, batch: str) -> None:
    """Rows and manifest of one batch; they do not count yet.

    ``offers`` are rows with location, file_week, run and offer_key (NULL: the
    run has emptied the week). Of several runs of a week the batch keeps the
    latest, numbers in run labels compared as numbers. A hot week is written
    by several tasks (``rebalance``).
    """
    latest = latest_per_week(offers.withColumn("run_key", run_order("run")), KEYS, "run_key")
    (latest.hint("rebalance", *KEYS).write.mode("overwrite").partitionBy(*KEYS).parquet(f"{path}/data/batch={batch}"))
    held = offers.sparkSession.read.schema(latest.schema).parquet(f"{path}/data/batch={batch}")
    held.groupBy(*KEYS).agg(F.max("run_key").alias("run_key")).write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")


def current_versions(spark: SparkSession, path: str) -> DataFrame:
    """(location, file_week, run_key, batch): the version of every key that counts."""
    live = versions.live_batches(spark, path)
    manifest = versions.read_batches(spark, path, "manifest").join(live, "batch")
    best = manifest.groupBy(*KEYS).agg(F.max(F.struct("run_key", "seq", "batch")).alias("v"))
    return best.select(*KEYS, "v.run_key", "v.batch")


def read_store(spark: SparkSession, path: str, weeks=None) -> DataFrame:
    """The offers that count; ``weeks`` reads the folders of those weeks only.

    The manifest, one row a key and batch, is joined with the data's folder
    columns, so files of versions that do not count can be pruned unread.
    """
    data = versions.read_batches(spark, path, "data", ("batch", *KEYS))
    current = current_versions(spark, path).select("batch", *KEYS)
    if weeks is not None:
        data, current = (x.where(F.col("file_week").isin(list(weeks))) for x in (data, current))
    on = [data[c].eqNullSafe(current[c]) for c in ("batch", *KEYS)]
    return data.join(current, on, "left_semi").where(F.col("offer_key").isNotNull()).drop("batch")


def compact(spark: SparkSession, path: str, batch: str) -> None:
    """Write what counts as one batch that replaces all others; readers see either state."""
    old = [r.batch for r in versions.live_batches(spark, path).collect()]      # names of batches, not rows
    if len(old) < 2:
        return
    current = current_versions(spark, path)
    data = versions.read_batches(spark, path, "data", ("batch", *KEYS))
    on = [data[c].eqNullSafe(current[c]) for c in ("batch", *KEYS)]
    data.join(current, on, "left_semi").drop("batch").hint("rebalance", *KEYS).write.mode("overwrite") \
        .partitionBy(*KEYS).parquet(f"{path}/data/batch={batch}")
    current.drop("batch").write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")
    versions.commit(spark, path, batch, old)
