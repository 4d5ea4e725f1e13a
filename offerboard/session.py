"""Session helpers.

Library code never creates a session of its own; ``get_spark`` is for tests,
``bench.py`` and scripts. ``shared_dir`` resolves the cluster's shared folder
(``spark.checkpoint.dir``), else a folder in the session's warehouse, which a
cluster shares too. Nothing is written to a machine-local temporary folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# SQL settings every plan in this package assumes. They are runtime settings,
# so they can be applied to a session someone else built.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows entering the Python stage are whole pages; keep each Arrow batch modest
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Settings of the table queries: a shuffled task's share stays small however large the input is. Up to
# 200 shares a map task needs no sort of its own (``spark.shuffle.sort.bypassMergeThreshold``).
TASK_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
}


def get_spark(master: str | None = None, app: str = "offerboard",
              shuffle_partitions: int | None = None, shared: str | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession, more=None) -> SparkSession:
    for k, v in {**SQL_CONF, **(more or {})}.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's checkpoint root for ``purpose``.

    The root is ``spark.checkpoint.dir``, else the session's warehouse. Each
    call returns a new sub folder, so reruns never need to clear old output.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if (warehouse.startswith("file:") or warehouse.startswith("/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("no shared folder: set spark.checkpoint.dir, the warehouse is a local folder of each machine")
        root = f"{warehouse.rstrip('/')}/offerboard"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def spread(df, key: str, spark: SparkSession | None = None):
    """Hash-partition ``df`` on ``key`` when its scan yields fewer tasks than the cluster has cores.

    CPU-heavy per-row stages (HTML parsing, regex over long texts) need at least
    one task per core. A large input already has one task per file split and is
    left as it is (no shuffle); a small file with one row group would otherwise
    run in a single task.
    """
    spark = spark or df.sparkSession
    try:
        want = spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:   # no RDD access (Spark Connect): leave the plan as it is
        return df
    if have >= want:
        return df
    return df.repartition(want, key)


def materialize(df, name: str, spark: SparkSession | None = None):
    """Write ``df`` once as parquet under the shared folder and read it back.

    Cuts the lineage of an expensive stage (the Python node table) that
    several branches of a plan read: it is computed once, survives executor
    loss, and later reads prune columns.
    """
    spark = spark or df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def literal_table(spark: SparkSession, rows, columns):
    """A small configuration table built JVM-side (no Python worker, no RDD).

    ``columns`` is a list of (name, type) pairs; rows are tuples in that order.
    """
    from pyspark.sql import functions as F
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, columns)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).select(*[F.col(n).cast(t) for n, t in columns])
