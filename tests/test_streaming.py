"""Streams (E5, E6): each arriving file once; a rerun reads only new files."""

import json
import os

from offerboard.streaming import offers_stream as ST


def test_document_stream_takes_each_file_once(spark, tmp_dir):
    src = f"{tmp_dir}/archive"
    os.makedirs(f"{src}/loc_a")
    with open(f"{src}/loc_a/2024-01.json", "w") as f:
        json.dump({"2024-01-02": [{"desc": "A", "price": 1.5}], "2024-01-03": []}, f)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def run():
        q = (ST.offers_document_stream(spark, src).writeStream.format("parquet")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
        q.awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 2
    with open(f"{src}/loc_a/2024-02.json", "w") as f:
        json.dump({"2024-01-09": [{"desc": "B", "price": 2}, {"desc": "C"}]}, f)
    got = run()
    assert got.count() == 4
    assert sorted(r.desc for r in got.filter("desc is not null").collect()) == ["A", "B", "C"]


def test_new_links_stream_dedupes(spark, tmp_dir):
    from conftest import SMALL
    path = ST.run_new_links_stream(spark, SMALL)
    urls = [r.url for r in spark.read.parquet(path).collect()]
    assert len(urls) == len(set(urls)) > 0


def test_archive_stream_into_store(spark, tmp_dir):
    src, store, ckpt = f"{tmp_dir}/archive", f"{tmp_dir}/store", f"{tmp_dir}/ckpt"
    os.makedirs(f"{src}/loc_a")
    with open(f"{src}/loc_a/2024-01.json", "w") as f:
        json.dump({"2024-01-02": [{"desc": "A", "price": 1.5}, {"desc": "Z", "price": ""}]}, f)
    ST.run_archive_to_store(spark, src, store, ckpt)
    with open(f"{src}/loc_a/2024-02.json", "w") as f:
        json.dump({"2024-01-09": [{"desc": "B", "price": 0}]}, f)
    ST.run_archive_to_store(spark, src, store, ckpt)
    got = {(r.file_week, r.desc, r.price_status) for r in ST.stored_offers(spark, store).collect()}
    assert got == {("2024-01", "A", "ok"), ("2024-01", "Z", "missing"), ("2024-02", "B", "zero")}


def test_rescraped_week_replaces_older(spark, tmp_dir):
    src, store, ckpt = f"{tmp_dir}/archive", f"{tmp_dir}/store", f"{tmp_dir}/ckpt"
    os.makedirs(f"{src}/loc_a")
    with open(f"{src}/loc_a/2024-02.json", "w") as f:
        json.dump({"2024-01-08": [{"desc": "old", "price": 1}], "2024-01-09": [{"desc": "old2", "price": 1}]}, f)
    ST.run_archive_to_store(spark, src, store, ckpt)
    with open(f"{src}/loc_a/2024-02@r2.json", "w") as f:
        json.dump({"2024-01-08": [{"desc": "new", "price": 2}]}, f)
    with open(f"{src}/loc_a/2024-03@r1.json", "w") as f:
        json.dump({"2024-01-15": [{"desc": "a", "price": 2}]}, f)
    with open(f"{src}/loc_a/2024-03@r2.json", "w") as f:
        json.dump({"2024-01-15": [{"desc": "b", "price": 2}]}, f)
    ST.run_archive_to_store(spark, src, store, ckpt)
    got = sorted((r.file_week, r.desc) for r in ST.stored_offers(spark, store).collect())
    assert got == [("2024-02", "new"), ("2024-03", "b")]
