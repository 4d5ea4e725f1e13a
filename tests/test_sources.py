"""Sources and sinks (section A) on a small archive written per test."""

import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from offerboard.sources import readers as R
from offerboard.sources import sinks as S
from offerboard.operators.quality import normalize_price

WEEK_DOC = {"2024-W01": [{"desc": "Gericht Eins", "price": 7.90}, {"desc": "Gericht Zwei", "price": 7.9}]}
DAY_DOC = ('{"2024-01-08": [], "2024-01-09": [{"desc": "A", "price": 3.50}, {"desc": "B"}, {"desc": "C", "price": null},'
           ' {"desc": "D", "price": ""}, {"desc": "E", "price": 0}, {"desc": "F", "price": 0.0}]}')


def _archive(root):
    os.makedirs(f"{root}/loc_a")
    os.makedirs(f"{root}/loc_b")
    with open(f"{root}/loc_a/2024-W01.json", "w") as f:
        json.dump(WEEK_DOC, f, ensure_ascii=False)
    with open(f"{root}/loc_a/2024-02.json", "w") as f:
        f.write(DAY_DOC)
    with open(f"{root}/loc_b/2000.json", "w") as f:
        f.write("{}")
    with open(f"{root}/loc_a/details.json", "w") as f:
        json.dump({"name": "Loc A", "link": "https://a.example/", "offers": {}, "details": ["Tee inklusive", "Karten ab 10 Euro"]}, f)
    with open(f"{root}/loc_b/details.json", "w") as f:
        json.dump({"name": "Loc B", "link": "https://b.example/", "offers": {}, "details": []}, f)
    return root


def test_scan_offers_and_prices(spark, tmp_dir):
    root = _archive(f"{tmp_dir}/data")
    rows = normalize_price(R.scan_offers(spark, root)).collect()
    assert len(rows) == 2 + 1 + 6          # empty day keeps one row, empty document none
    by = {(r.offer_key, r.desc): r for r in rows}
    assert by[("2024-01-08", None)].pos is None
    assert by[("2024-W01", "Gericht Eins")].price == Decimal("7.90")
    assert by[("2024-W01", "Gericht Zwei")].file_week == "2024-W01"
    st = {r.desc: (r.price, r.price_status) for r in rows if r.offer_key == "2024-01-09"}
    assert st == {"A": (Decimal("3.50"), "ok"), "B": (None, "missing"), "C": (None, "missing"),
                  "D": (None, "missing"), "E": (Decimal("0.00"), "zero"), "F": (Decimal("0.00"), "zero")}
    assert {r.location for r in rows} == {"loc_a"}


def test_locations_and_bundle(spark, tmp_dir):
    root = _archive(f"{tmp_dir}/data")
    locs = R.scan_locations(spark, root)
    assert {r.location: r.details for r in locs.collect()} == {
        "loc_a": ["Tee inklusive", "Karten ab 10 Euro"], "loc_b": []}
    offers = normalize_price(R.scan_offers(spark, root))
    bundle = {r.location: r for r in S.publish_bundle(offers, locs).collect()}
    assert bundle["loc_b"].offers == {}
    a = json.loads(bundle["loc_a"].json)
    assert a["offers"]["2024-01-08"] == []
    assert [m["desc"] for m in a["offers"]["2024-01-09"]] == ["A", "B", "C", "D", "E", "F"]
    assert a["details"] == ["Tee inklusive", "Karten ab 10 Euro"]
    week_only = {r.location: r for r in S.publish_bundle(offers, locs, keys=F.col("offer_key").startswith("2024-W")).collect()}
    assert list(week_only["loc_a"].offers) == ["2024-W01"]


def test_write_offers_replaces_only_its_week(spark, tmp_dir):
    root = _archive(f"{tmp_dir}/data")
    store = f"{tmp_dir}/store"
    offers = normalize_price(R.scan_offers(spark, root))
    S.write_offers(offers, store)
    again = offers.filter(F.col("file_week") == "2024-02").filter(F.col("desc") == "A")
    S.write_offers(again, store)
    back = spark.read.parquet(store)
    assert back.filter("file_week = '2024-02'").count() == 1
    assert back.filter("file_week = '2024-W01'").count() == 2


def test_scan_usage(spark, tmp_dir):
    d = f"{tmp_dir}/usage/loc_a"
    os.makedirs(d)
    with open(f"{d}/usage.json", "w") as f:
        json.dump({"completion_tokens": 250, "prompt_tokens": 700, "total_tokens": 950}, f)
    with open(f"{d}/openai_gpt-4o-2024-08-06_usage.json", "w") as f:
        json.dump({"completion_tokens": 120, "completion_tokens_details": {"reasoning_tokens": 0},
                   "prompt_tokens": 880, "prompt_tokens_details": {"audio_tokens": 0, "cached_tokens": 640},
                   "total_tokens": 1000}, f)
    rows = {(r.provider, r.model): r for r in R.scan_usage(spark, f"{tmp_dir}/usage").collect()}
    assert rows[(None, None)].total_tokens == 950 and rows[(None, None)].cached_tokens is None
    r = rows[("openai", "gpt-4o-2024-08-06")]
    assert (r.location, r.prompt_tokens, r.cached_tokens) == ("loc_a", 880, 640)


def test_csv_table_and_lines(spark, tmp_dir):
    d = f"{tmp_dir}/csv"
    os.makedirs(d)
    lines = ["id,Kategorie,Montag,Dienstag,Mittwoch,Donnerstag,Freitag",
             '0,Suppe,"Erbsen, mit Wurst 2,50 €",,Tomate 2,50 €,,',
             "1,Hauptgericht,Schnitzel 5,90 €,Gulasch 5,90 €,,Fisch 6,20 €,Pasta 5,50 €",
             "2,Dessert,,,,,", "3,Beilage,Reis,Kartoffeln,,,", "4,skip me,x,x,x,x,x", "5,skip me too,x,x,x,x,x",
             "6,Salat,,Gurke 1,00 €,,,"]
    with open(f"{d}/table.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    cells = R.scan_csv_table(spark, d, skip_rows=[4, 5])
    named = R.csv_table_columns(cells, ["category", "mon", "tue", "wed", "thu", "fri"], keep_cols=[1, 2, 3, 4, 5, 6])
    assert named.count() == 5
    from offerboard.operators.menus import unpivot_week_table
    long = unpivot_week_table(named, ["category"], ["mon", "tue", "wed", "thu", "fri"])
    got = sorted((r.category, r.day, r.cell) for r in long.collect())
    assert ("Suppe", "mon", "Erbsen, mit Wurst 2,50 €") in got
    assert len(got) == 11
    out = f"{tmp_dir}/out"
    S.csv_sink(named.select("category", "mon"), out)
    assert spark.read.csv(out).count() == 5
    doc_lines = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (2, 0, "z")], "doc_id bigint, pos bigint, line string")
    assert {r.doc_id: r.text for r in S.document_text(doc_lines).collect()} == {1: "a\nb", 2: "z"}
    assert {r.doc_id: r.text for r in S.document_text(doc_lines, first_only=True).collect()} == {1: "a", 2: "z"}
    S.lines_sink(doc_lines, f"{tmp_dir}/lines", first_only=False)
    assert {r.doc_id: r.text for r in spark.read.json(f"{tmp_dir}/lines").collect()} == {1: "a\nb", 2: "z"}


def test_week_table_flow(spark, tmp_dir):
    """OCR week table: read with row skipping (A8), unpivot (C15), prices (C7), weekday dates (C4), empty days gone."""
    import datetime as dt
    from offerboard.operators.menus import extract_week_table
    d = f"{tmp_dir}/week"
    os.makedirs(d)
    lines = ["Kategorie,Montag,Dienstag,Mittwoch,Donnerstag,Freitag",
             'Suppe,"Erbsensuppe 2,50 €",,"Tomatensuppe 2,50 €",,',
             'Hauptgericht,"Schnitzel 5,90 € (a)","Gulasch 5,90 €",,"Fisch 6,20 €",',
             'Vegetarisch,"Pasta 4,80 €",,,"Curry 4,80 €",',
             "Hinweis,x,x,x,x,x", "Hinweis,y,y,y,y,y"]
    with open(f"{d}/table.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    cells = R.scan_csv_table(spark, d, skip_rows=[3, 4])
    days = ["mo", "di", "mi", "do", "fr"]
    table = R.csv_table_columns(cells, ["kategorie", *days]).withColumn("week_start", F.lit(dt.date(2024, 1, 8)))
    rows = extract_week_table(table, "file", "kategorie", days).collect()
    got = sorted((r.offer_key, r.pos, r.desc, r.price) for r in rows)
    assert got == [("2024-01-08", 0, "Erbsensuppe", Decimal("2.50")), ("2024-01-08", 1, "Schnitzel", Decimal("5.90")),
                   ("2024-01-08", 2, "Pasta", Decimal("4.80")), ("2024-01-09", 1, "Gulasch", Decimal("5.90")),
                   ("2024-01-10", 0, "Tomatensuppe", Decimal("2.50")), ("2024-01-11", 1, "Fisch", Decimal("6.20")),
                   ("2024-01-11", 2, "Curry", Decimal("4.80"))]
