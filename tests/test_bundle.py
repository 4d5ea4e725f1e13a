"""The published document: its part files in order are valid JSON with the offers of every location; places of rows."""
import glob
import json

from offerboard.operators import board as B
from offerboard.sources import bundle

OFFERS = "location string, offer_key string, pos long, desc string, price decimal(10,2)"
PLACES = "location string, name string, link string, details array<string>"


def test_part_files_are_the_document(spark, tmp_dir):
    from decimal import Decimal
    rows = [("b", "2024-01-08", i, f'meal "{i}"\n', Decimal("1.50") if i % 2 else None) for i in range(25)]
    rows += [("b", "2024-01-09", None, None, None), ("b", "2024-W02", 3, "ü \\ ]}", Decimal("2.00")), ("a", "2024-01-08", 1, None, None),
             ("a", "2024-01-08", None, None, None), ("unknown", "2024-01-08", 1, "x", None), ("a", None, 1, "no key", None)]
    offers = spark.createDataFrame(rows, OFFERS)
    places = spark.createDataFrame([("b", "B \"x\"", None, ["cash", "card"]), ("a", "A", "l", None), ("c", None, "l", [])], PLACES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bundle.write_bundle(bundle.bundle_lines(offers, places, 10), f"{tmp_dir}/out")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(glob.glob(f"{tmp_dir}/out/part-*"))
    assert len(parts) > 1
    doc = json.loads("".join(open(p, encoding="utf-8").read() for p in parts))
    meal = lambda d, p: {"desc": d, "price": p}
    assert doc == {"locations": [
        {"name": "A", "link": "l", "details": None, "offers": {"2024-01-08": [meal(None, None)]}},
        {"name": 'B "x"', "link": None, "details": ["cash", "card"], "offers": {
            "2024-01-08": [meal(f'meal "{i}"\n', 1.5 if i % 2 else None) for i in range(25)], "2024-01-09": [],
            "2024-W02": [meal("ü \\ ]}", 2.0)]}},
        {"name": None, "link": "l", "details": [], "offers": {}}]}
    assert max(line.count('"desc"') for p in parts for line in open(p, encoding="utf-8")) == 10


def test_no_locations_is_an_empty_document(spark, tmp_dir):
    lines = bundle.bundle_lines(spark.createDataFrame([], OFFERS), spark.createDataFrame([], PLACES))
    assert json.loads("".join(r.value for r in lines.orderBy(*bundle.ORDER).collect())) == {"locations": []}


def test_places_are_the_sort_order(spark):
    df = spark.range(5000).selectExpr("id", "pmod(hash(id), 70) AS k").repartition(7)
    got = [(r.k, r.id) for r in sorted(B.positioned(df, ["k", "id"]).collect(), key=lambda r: r.position)]
    assert got == sorted(got) and sorted(r.position for r in B.positioned(df, ["k", "id"]).collect()) == list(range(5000))
    assert B.positioned(df.limit(0), ["k"]).count() == 0
