"""The versioned offers store and the bucketed seen-set: commits, retries, late batches, pruned reads, merges."""
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from offerboard.operators import seen as Q
from offerboard.operators.quality import normalize_price
from offerboard.sources import store, versions
from offerboard.streaming import offers_stream as ST

OFFERS = "location string, file_week string, run string, offer_key string, pos long, desc string, price_raw string"


def offers(spark, rows):
    return normalize_price(spark.createDataFrame([(l, w, r, k, 0, d, "1") for l, w, r, k, d in rows], OFFERS))


def stored(spark, path, **more):
    return sorted((r.location, r.file_week, r.desc) for r in store.read_store(spark, path, **more).collect())


def put(spark, path, batch, rows):
    store.write_batch(offers(spark, rows), path, batch)
    versions.commit(spark, path, batch)


def test_a_batch_counts_once_committed(spark, tmp_dir):
    put(spark, tmp_dir, "a-0", [("x", "2024-01", None, "2024-01-02", "old"), ("y", "2024-01", None, "2024-01-02", "stays")])
    before = stored(spark, tmp_dir)
    new = offers(spark, [("x", "2024-01", "r2", "2024-01-02", "new"), ("x", "2024-02", "r2", "2024-01-09", "next")])
    store.write_batch(new, tmp_dir, "a-1")                 # the driver stops here: two weeks written, none counts
    assert stored(spark, tmp_dir) == before == [("x", "2024-01", "old"), ("y", "2024-01", "stays")]
    store.write_batch(new, tmp_dir, "a-1")                 # the retried batch
    versions.commit(spark, tmp_dir, "a-1")
    after = [("x", "2024-01", "new"), ("x", "2024-02", "next"), ("y", "2024-01", "stays")]
    assert stored(spark, tmp_dir) == after
    versions.commit(spark, tmp_dir, "a-1")                 # told twice
    assert stored(spark, tmp_dir) == after and versions.commits(spark, tmp_dir).count() == 2
    assert stored(spark, tmp_dir, weeks=["2024-02"]) == [("x", "2024-02", "next")]


def test_late_empty_and_repeated_runs(spark, tmp_dir):
    put(spark, tmp_dir, "0", [("x", "01", "r2", "k", "two"), ("x", "01", "r10", "k", "ten"), ("z", "01", "r1", "k", "z")])
    put(spark, tmp_dir, "1", [("x", "01", "r9", "k", "late"), ("z", "01", "r2", None, None)])
    assert stored(spark, tmp_dir) == [("x", "01", "ten")]
    put(spark, tmp_dir, "2", [("x", "01", "r10", "k", "again"), ("z", "01", "r3", "k", "back")])
    want = [("x", "01", "again"), ("z", "01", "back")]
    assert stored(spark, tmp_dir) == want
    store.compact(spark, tmp_dir, "merged")
    assert stored(spark, tmp_dir) == want and [r.batch for r in versions.live_batches(spark, tmp_dir).collect()] == ["merged"]
    put(spark, tmp_dir, "3", [("x", "01", "r3", "k", "late again"), ("x", "02", "r1", "k", "w2")])
    assert stored(spark, tmp_dir) == [("x", "01", "again"), ("x", "02", "w2"), ("z", "01", "back")]


def test_an_empty_batch_and_an_empty_store(spark, tmp_dir):
    put(spark, tmp_dir, "0", [])
    put(spark, tmp_dir, "1", [("x", "01", None, "k", "a")])
    assert stored(spark, tmp_dir) == [("x", "01", "a")]


def frame(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def test_new_urls_against_a_set(spark, tmp_dir):
    rnd = random.Random(3)
    seen, known = Q.SeenUrls(spark, tmp_dir, buckets=8, blocks=4), set()
    for i in range(4):
        urls = [f"https://x.org/{rnd.randint(0, 900)}" for _ in range(500)] + ["https://hot.org/"] * 300 + [None]
        got = [r.url for r in seen.add(frame(spark, urls), f"r-{i}").collect()]
        assert len(got) == len(set(got)) and set(got) == set(urls) - known - {None}
        known |= set(urls) - {None}
        if i == 2:
            assert seen.merge("r-merged") and len(versions.live_batches(spark, tmp_dir).collect()) == 1
    all_urls = [r.url for r in seen.urls().collect()]
    assert len(all_urls) == len(known) and set(all_urls) == known


def test_a_retried_batch_replaces_itself(spark, tmp_dir):
    seen = Q.SeenUrls(spark, tmp_dir)
    for batch, urls in (("one-0", "abc"), ("two-0", "az"), ("two-0", "az")):
        seen.add(frame(spark, urls), batch)
    assert sorted(r.url for r in seen.urls().collect()) == ["a", "b", "c", "z"]
    seen._write = None
    with pytest.raises(TypeError):                         # stops before the commit
        seen.add(frame(spark, "q"), "three-0")
    assert seen.urls().count() == 4


def test_only_touched_buckets_are_read(spark, tmp_dir):
    seen = Q.SeenUrls(spark, tmp_dir, buckets=8, blocks=4)
    urls = [f"https://x.org/{i}" for i in range(300)]
    seen.add(frame(spark, urls), "r-0")
    again = urls[:1]
    bucket = seen.new(frame(spark, again), without="r-0").first().bucket
    for f in glob.glob(f"{tmp_dir}/urls/batch=r-0/bucket=*/*.parquet"):
        if f"bucket={bucket}/" not in f:
            os.truncate(f, 10)                              # reading another bucket would fail now
    spark.catalog.clearCache()
    assert seen.add(frame(spark, again), "r-1").count() == 0


def test_filters_forget_nothing_and_rarely_err(spark):
    rows = spark.range(4000).select(F.concat(F.lit("u"), F.col("id")).alias("url")).withColumn("block", Q.block_of(F.col("url"), 2, 1))
    held = rows.where(F.xxhash64("url") % 2 == 0)
    got = Q.maybe_seen(rows, Q.filters(held)).withColumn("held", F.xxhash64("url") % 2 == 0)
    assert got.where("held and not maybe").count() == 0
    assert got.where("not held and maybe").count() < 40


def test_streams_leave_the_state_store_choice_alone(spark):
    before = spark.conf.get(ST.PROVIDER, None)
    from conftest import SMALL
    ST.run_new_links_stream(spark, SMALL)
    assert spark.conf.get(ST.PROVIDER, None) == before
