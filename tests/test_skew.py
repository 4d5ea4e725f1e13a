"""One key holding a large share of all rows: results stay whole, lists stay bounded."""

from pyspark.sql import functions as F

from offerboard.operators import board as B
from offerboard.operators import incremental as E
from offerboard.operators import menus as C
from offerboard.operators import quality as Q


def _hot_offers(spark, n_hot=3000, n_cold=1500):
    hot = spark.range(n_hot).select(F.lit("hot").alias("location"), F.lit("2024-01-09").alias("offer_key"),
                                    F.col("id").alias("pos"), (F.col("id") % 7).cast("string").alias("desc"),
                                    F.lit(5).cast("decimal(10,2)").alias("price"))
    cold = spark.range(n_cold).select(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("location"),
                                      F.lit("2024-01-09").alias("offer_key"), F.col("id").alias("pos"),
                                      F.col("id").cast("string").alias("desc"), F.lit(3).cast("decimal(10,2)").alias("price"))
    return hot.unionByName(cold)


def test_nested_lists_are_bounded_and_whole(spark):
    nested = C.nest_offers(_hot_offers(spark), keys=("location", "offer_key"), max_items=500)
    sizes = nested.select("location", F.size("meals").alias("n")).collect()
    assert max(r.n for r in sizes) <= 500
    assert sum(r.n for r in sizes) == 4500
    assert sum(r.n for r in sizes if r.location == "hot") == 3000


def test_board_and_quality_on_hot_key(spark):
    offers = _hot_offers(spark)
    rows = B.board_rows(offers, "2024-01-09")
    assert rows.filter("location = 'hot'").count() == 3000
    dup = {r.desc: r.n for r in Q.duplicate_meals(offers).filter("location = 'hot'").collect()}
    assert sum(dup.values()) == 3000 and len(dup) == 7
    runs = offers.withColumn("file_week", F.lit("2024-W02")).withColumn("run_ts", F.col("pos") % 3)
    latest = E.latest_per_week(runs, ("location", "file_week"), "run_ts")
    assert latest.filter("location = 'hot'").count() == 1000


def test_hot_url_new_links(spark):
    links = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit("https://hot/")).otherwise(
        F.concat(F.lit("https://u/"), F.col("id").cast("string"))).alias("url"))
    seen = spark.range(100).select(F.concat(F.lit("https://u/"), F.col("id").cast("string")).alias("url"))
    new = E.new_links(links.distinct(), seen)
    expected = {f"https://u/{i}" for i in range(100, 5000) if i % 3} | {"https://hot/"}
    assert {r.url for r in new.collect()} == expected


def test_chunked_sections_equal_plain(spark):
    from conftest import SMALL
    conv = spark.read.parquet(f"{SMALL}/conversations.parquet")
    head = F.when(F.col("role") == "user", F.col("role"))
    plain = C.assign_sections(conv, head, key="conv_id", pos="turn")
    cols = ["conv_id", "turn", "section", "section_pos", "is_heading"]
    want = sorted(tuple(r) for r in plain.select(*cols).collect())
    for chunk in (1, 2, 3):
        got = sorted(tuple(r) for r in C.assign_sections(conv, head, key="conv_id", pos="turn", chunk=chunk)
                     .select(*cols).collect())
        assert got == want
    hot = spark.range(20000).select(F.lit(1).alias("doc_id"), F.col("id").alias("pos"),
                                    F.when(F.col("id") % 997 == 5, F.concat(F.lit("H"), F.col("id").cast("string"))).alias("h"))
    a = C.assign_sections(hot, F.col("h"), chunk=1000).select("pos", "section").collect()
    assert all((r.section is None) == (r.pos < 5) for r in a)
    assert {r.pos: r.section for r in a}[19999] == "H" + str(max(i for i in range(20000) if i % 997 == 5))


def test_spread_only_widens_narrow_inputs(spark):
    from offerboard.session import spread
    cores = spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, 1, cores * 2)
    assert spread(wide, "id") is wide                      # enough splits: plan untouched, no shuffle
    narrow = spark.range(0, 1000, 1, 1)
    assert spread(narrow, "id").rdd.getNumPartitions() == cores
