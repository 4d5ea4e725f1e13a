"""E1/E6 for a large seen-set: urls in hash buckets, a Bloom filter per block, small batches merged.

A seen table that every batch reads whole costs more with each batch. Here a
url's hash names its bucket, a folder of the table, and its block, one of
several in a bucket. A block's Bloom filter is one bitmap of 32,768 bits. A
batch first asks the filters, one row a block: a url whose bits are not all set
is new. Only for the others are urls read, and only from their buckets.

A batch counts once committed (``sources.versions``); a retried batch replaces
its own files and leaves out what it added itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerboard.sources import versions

BUCKETS = 64
BLOCKS = 64          # filter blocks of a bucket
BITS = 32_768        # bits of a block, one bitmap
PROBES = 5           # bits that a url sets
SCHEMA = {"urls": "url string, block long, bucket int, batch string", "filters": "block long, bits binary, batch string"}


def block_of(url: Column, buckets: int = BUCKETS, blocks: int = BLOCKS) -> Column:
    """The block of a url: its bucket is ``block div blocks``."""
    return F.pmod(F.xxhash64(url), F.lit(buckets * blocks))


def positions(url: Column) -> Column:
    """The bits of a url in its block."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(f"probe {i}"), url), F.lit(BITS)) for i in range(PROBES)])


def _bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), F.pmod(position, F.lit(8)))).cast("long") % 2 == 1


def filters(urls: DataFrame) -> DataFrame:
    """(block, bits) of (url, block): one bitmap a block, partial bitmaps combined before the shuffle."""
    bits = urls.select("block", F.explode(positions(F.col("url"))).alias("position"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits"))


def maybe_seen(urls: DataFrame, blooms: DataFrame) -> DataFrame:
    """``urls`` (url, block) with ``maybe``: whether the block's filter holds all bits of the url."""
    known = blooms.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
    hit = F.forall(positions(F.col("url")), lambda p: _bit(F.col("bits"), p))
    return urls.join(known, "block", "left").withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("bits")


class SeenUrls:
    """The seen-set at ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, blocks: int = BLOCKS):
        self.spark, self.path, self.buckets, self.blocks = spark, path, buckets, blocks

    def _live(self, part: str, without: str | None = None) -> DataFrame | None:
        live = versions.live_batches(self.spark, self.path)
        names = [r.batch for r in live.collect() if r.batch != without]      # as many as batches since the last merge
        if not names:
            return None
        folders = [f"{self.path}/{part}/batch={n}" for n in names]
        return self.spark.read.schema(SCHEMA[part]).option("basePath", f"{self.path}/{part}").parquet(*folders)

    def urls(self) -> DataFrame:
        """All urls seen."""
        seen = self._live("urls")
        return self.spark.createDataFrame([], "url string") if seen is None else seen.select("url")

    def new(self, links: DataFrame, without: str | None = None, url: str = "url") -> DataFrame:
        """(url, block, bucket) of the distinct urls of ``links`` that no live batch but ``without`` holds; NULL is no url.

        Distinct comes first, so a url on every page is one row a task before
        any shuffle. The buckets read are at most ``buckets`` numbers.
        """
        mine = links.select(F.col(url).alias("url")).where(F.col("url").isNotNull()).distinct()
        mine = mine.withColumn("block", block_of(F.col("url"), self.buckets, self.blocks))
        seen = self._live("urls", without)
        if seen is not None:
            marked = maybe_seen(mine, self._live("filters", without))
            touched = [r.b for r in marked.where("maybe").select(F.floor(F.col("block") / self.blocks).alias("b")).distinct().collect()]
            held = seen.where(F.col("bucket").isin(touched)).select("url")
            mine = marked.where(~F.col("maybe")).unionByName(marked.where("maybe").join(held, "url", "left_anti")).drop("maybe")
        return mine.withColumn("bucket", F.floor(F.col("block") / self.blocks).cast("int"))

    def _write(self, fresh: DataFrame, batch: str, replaces=()) -> DataFrame:
        """Urls first, clustered by bucket; the filters come from what was written."""
        out = f"{self.path}/urls/batch={batch}"
        fresh.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
        written = self.spark.read.schema(SCHEMA["urls"].replace(", batch string", "")).parquet(out)
        filters(written).write.mode("overwrite").parquet(f"{self.path}/filters/batch={batch}")
        versions.commit(self.spark, self.path, batch, replaces)
        return written.select("url")

    def add(self, links: DataFrame, batch: str, url: str = "url") -> DataFrame:
        """Add a batch; returns its new urls, as written."""
        return self._write(self.new(links, batch, url), batch)

    def merge(self, batch: str, least: int = 2) -> bool:
        """Write the live batches as one if there are ``least`` of them at least; readers see either state."""
        old = [r.batch for r in versions.live_batches(self.spark, self.path).collect()]
        if len(old) < max(2, least):
            return False
        self._write(self._live("urls").select("url", "block", "bucket"), batch, old)
        return True
