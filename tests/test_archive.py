"""Offers archive invariants; runs only when OFFERS_ARCHIVE points at an archive folder
(``<location>/<week>.json`` plus ``<location>/details.json``)."""

import os

import pytest
from pyspark.sql import functions as F

from offerboard.operators.quality import check_keys, duplicate_meals, normalize_price
from offerboard.sources.readers import scan_locations, scan_offers

ARCHIVE = os.environ.get("OFFERS_ARCHIVE")
pytestmark = pytest.mark.skipif(not ARCHIVE or not os.path.isdir(ARCHIVE), reason="OFFERS_ARCHIVE not set")


def test_archive_counts(spark):
    offers = normalize_price(scan_offers(spark, ARCHIVE)).cache()
    files = offers.select("location", "file_week").distinct().count()
    keys = offers.select("location", "file_week", "offer_key").distinct()
    meals = offers.filter(F.col("pos").isNotNull())
    empty = offers.filter(F.col("pos").isNull())
    print({"files_with_keys": files, "keys": keys.count(), "meals": meals.count(), "empty_keys": empty.count(),
           "null_prices": meals.filter(F.col("price").isNull()).count(),
           "zero_prices": meals.filter(F.col("price_status") == "zero").count(),
           "locations": scan_locations(spark, ARCHIVE).count(),
           "weekend_keys": check_keys(keys).filter("is_weekend").count(),
           "bad_weeks": check_keys(keys).filter("bad_week").count(),
           "duplicates": duplicate_meals(offers).count()})
    assert keys.count() == 2279
    assert meals.count() == 4818
    assert empty.count() == 148
    assert meals.filter(F.col("price").isNull()).count() == 80
    offers.unpersist()


def test_archive_as_stream(spark, tmp_dir):
    from offerboard.streaming.offers_stream import offers_document_stream
    q = (offers_document_stream(spark, ARCHIVE).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start(f"{tmp_dir}/out"))
    q.awaitTermination()
    rows = spark.read.parquet(f"{tmp_dir}/out")
    assert rows.select("location", "file_week", "offer_key").distinct().count() == 2279
    assert rows.filter("pos is not null").count() == 4818
