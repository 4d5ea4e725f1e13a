"""Streams of arriving files: offers documents/events (E5) and pages' links.

Both run as ``trigger(availableNow=True)``: every file that has arrived is
processed exactly once, progress is kept in a checkpoint under the cluster's
shared folder, and a rerun only reads new files. The file sink commits each
micro-batch atomically, so a lost executor only repeats that batch.
"""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerboard.operators.links import absolutize, extract_links, site_base
from offerboard.operators.quality import normalize_price
from offerboard.operators.seen import SeenUrls
from offerboard.plans.views import offers_from_events
from offerboard.session import shared_dir
from offerboard.sources import store, versions

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
MERGE_FROM = 16          # live batches of the seen-set that are merged into one


@contextmanager
def _rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, on disk; the session's own choice holds again afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, STATE_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _file_glob(sf_dir: str, table: str) -> str:
    # a glob (not a plain file path) so the file source watches for new files of this table
    return f"{sf_dir.rstrip('/')}/{table}.parque[t]"


def offers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 on the driver tables: events arriving as files -> offer rows.

    The file source takes each file exactly once, so no state is kept.
    """
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(_file_glob(sf_dir, "events"))
    return offers_from_events(events)


def offers_document_stream(spark: SparkSession, path: str) -> DataFrame:
    """E5 on an offers archive: every new ``<location>/<week>[@<run>].json`` document as long offer rows.

    A file source reads each file once and never again, so a re-scraped week
    arrives as a new file ``<week>@<run>.json``.
    """
    from offerboard.sources.readers import parse_offers_documents
    docs = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "[0-9]*.json")
            .option("recursiveFileLookup", True).load(path)
            .select("value", F.col("_metadata.file_path").alias("file_path")))
    return parse_offers_documents(docs, keep_empty=True)


def new_links_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 in the keyed-state form: absolute links of arriving pages, each url emitted once.

    ``dropDuplicates`` keeps the seen-set in the state store. A url found on
    most pages is combined first: every task sends one row per url and Arrow
    batch to the shuffle, not one per occurrence.
    """
    def distinct(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).unique()], names=["url"])

    return page_links_stream(spark, sf_dir).mapInArrow(distinct, "url string").dropDuplicates(["url"])


def page_links_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute links of arriving pages (no state)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet").schema
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(_file_glob(sf_dir, "pages"))
    return absolutize(extract_links(pages), site_base("url"), out="abs_url").select(F.col("abs_url").alias("url"))


def seen_table_batch(seen: SeenUrls, run: str):
    """foreachBatch body of E1 over a stream: new urls of a micro-batch are added to the seen-set.

    The batch is named ``<run>-<epoch>``, so a retried one replaces its own
    output instead of adding twice. ``run`` names the checkpoint: one with a
    new checkpoint counts its epochs from 0 again and must not meet the batches
    of an earlier one. Every MERGE_FROM batches the small ones are merged.
    """
    def add(batch: DataFrame, epoch_id: int) -> None:
        seen.add(batch, f"{run}-{epoch_id}")
        seen.merge(f"{run}-{epoch_id}-merged", MERGE_FROM)
    return add


def run_seen_table_stream(spark: SparkSession, sf_dir: str) -> SeenUrls:
    """E1 over a stream of page files; returns the seen-set."""
    seen = SeenUrls(spark, shared_dir(spark, "seen-links"))
    ckpt = shared_dir(spark, "seen-links-checkpoint")
    q = (page_links_stream(spark, sf_dir).writeStream.foreachBatch(seen_table_batch(seen, ckpt.rsplit("/", 1)[-1]))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return seen


def run_to_table(stream: DataFrame, spark: SparkSession, name: str, partition_by=()) -> str:
    """Run a stream over everything that has arrived (availableNow) into a parquet table; return its path."""
    out = shared_dir(spark, f"{name}-table")
    ckpt = shared_dir(spark, f"{name}-checkpoint")
    w = stream.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(out)
    q.awaitTermination()
    return out


def store_batch(store_path: str, run: str = "run"):
    """foreachBatch body of E5: a micro-batch of offers adds its weeks to the versioned store (``sources.store``).

    The batch counts as a whole once committed. A run older than the stored
    one changes nothing, whenever it arrives; a retried batch replaces itself.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        name = f"{run}-{epoch_id}"
        store.write_batch(normalize_price(batch), store_path, name)
        versions.commit(batch.sparkSession, store_path, name)
    return write


def stored_offers(spark: SparkSession, store_path: str) -> DataFrame:
    """The store's offers; weeks whose latest run was empty have none."""
    return store.read_store(spark, store_path)


def run_archive_to_store(spark: SparkSession, archive: str, store_path: str, checkpoint: str) -> None:
    """E5: every offers document that has arrived in ``archive``, each once, into the partitioned store."""
    q = (offers_document_stream(spark, archive).writeStream.foreachBatch(store_batch(store_path, checkpoint.rstrip("/").rsplit("/", 1)[-1]))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_offers_stream(spark: SparkSession, sf_dir: str) -> str:
    return run_to_table(offers_stream(spark, sf_dir), spark, "offers-stream", ("location",))


def run_new_links_stream(spark: SparkSession, sf_dir: str) -> str:
    with _rocksdb(spark):
        return run_to_table(new_links_stream(spark, sf_dir), spark, "new-links-stream")

