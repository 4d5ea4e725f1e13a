"""Column functions: week labels, periods, prices, text."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from offerboard.functions import (ascii_fold, clean_desc, normalize_price, parse_period, parse_price, safe_name,
                                  split_desc_price, starts_with_year, strip_footnotes, week_label)
from offerboard.functions.html import meta_property, page_title, text_lines

DATES = {  # date: (board, iso)
    "2021-01-01": ("2020-W53", "2020-W53"),
    "2023-01-01": ("2022-W52", "2022-W52"),
    "2024-01-01": ("2024-W01", "2024-W01"),
    "2024-12-30": ("2024-W01", "2025-W01"),
    "2025-01-01": ("2024-W01", "2025-W01"),
    "2026-12-31": ("2026-W53", "2026-W53"),
}


def test_week_labels(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "d string").select(
        "d", week_label(F.to_date("d"), "board").alias("b"), week_label(F.to_date("d"), "iso").alias("i"))
    assert {r.d: (r.b, r.i) for r in df.collect()} == DATES


def test_parse_period(spark):
    rows = [("01. – 05. Januar 2024", dt.date(2024, 1, 1)),
            ("Woche 01.01.2024 - 05.01.2024", dt.date(2024, 1, 1)),
            ("29. Januar – 02. Februar 2024", dt.date(2024, 1, 29)),
            ("30. Dezember – 03. Januar 2025", dt.date(2024, 12, 30)),
            ("Montag – Freitag von 12 – 14 Uhr", None),
            ("31.02.2024 - 04.03.2024", None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string").select("t", parse_period("t").alias("p"))
    assert {r.t: r.p for r in df.collect()} == dict(rows)


def test_prices(spark):
    rows = ["jedes Gericht 7,90 €", "Sauerbraten 6.90 €", "Bratwurst 7,50€ dazu Salat", "ohne Preis", None]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    desc, price = split_desc_price(F.col("t"))
    got = {r.t: (r.d, r.p) for r in df.select("t", desc.alias("d"), price.alias("p")).collect()}
    assert got["jedes Gericht 7,90 €"] == ("jedes Gericht", Decimal("7.90"))
    assert got["Sauerbraten 6.90 €"] == ("Sauerbraten", Decimal("6.90"))
    assert got["Bratwurst 7,50€ dazu Salat"] == ("Bratwurst", Decimal("7.50"))
    assert got["ohne Preis"] == ("ohne Preis", None)
    assert df.select(parse_price("t").alias("p")).filter("p is null").count() == 2


def test_normalize_price_edge_rows(spark):
    rows = [(None,), ("",), ("0",), ("0.00",), ("3.5",), ("7.90",), ("abc",)]
    df = spark.createDataFrame(rows, "raw string")
    price, status = normalize_price(F.col("raw"))
    got = [(r.raw, r.p, r.s) for r in df.select("raw", price.alias("p"), status.alias("s")).collect()]
    assert got == [(None, None, "missing"), ("", None, "missing"), ("0", Decimal("0.00"), "zero"),
                   ("0.00", Decimal("0.00"), "zero"), ("3.5", Decimal("3.50"), "ok"), ("7.90", Decimal("7.90"), "ok"),
                   ("abc", None, "invalid")]


def test_text_helpers(spark):
    df = spark.createDataFrame([("MITTAGSKARTE Ä", "https://a.b/c/d", "Pasta mit Soße a,g.i", "Zeile\neins\t zwei ",
                                 "2026-05-18T09:19:30+00:00")], "a string, u string, f string, c string, m string")
    r = df.select(ascii_fold("a").alias("a"), safe_name("u", "loc_").alias("u"), strip_footnotes("f").alias("f"),
                  clean_desc("c").alias("c"), starts_with_year("m").alias("m")).collect()[0]
    assert r.a == "mittagskarte Ä"
    assert r.u == "loc_https_a.b_c_d.html"
    assert r.f == "Pasta mit Soße"
    assert r.c == "Zeile eins zwei"
    assert r.m is True


def test_footnote_forms(spark):
    rows = ["Linsentopf mit Wurzelgemüse ag", "Fischfilet in Dillsoße aw,i,j,11",
            "Käseplatte mit Trauben a.aWc239", "Milchreis mit Zimt aR,g,2", "Nudeln mit Pesto"]
    df = spark.createDataFrame([(t,) for t in rows], "t string").select(strip_footnotes("t").alias("t"))
    assert [r.t for r in df.collect()] == ["Linsentopf mit Wurzelgemüse", "Fischfilet in Dillsoße",
                                          "Käseplatte mit Trauben", "Milchreis mit Zimt",
                                          "Nudeln mit Pesto"]


def test_html_expressions(spark):
    html = ('<html><head><title>Speise &amp; Trank</title><meta property="article:modified_time" '
            'content="2024-05-01T10:00:00+00:00"><script>var t="</p>";</script><style>p{}</style></head>'
            '<body><!-- c --><p> eins&nbsp;</p><p>zwei<b>drei</b></p></body></html>')
    df = spark.createDataFrame([(html,), ("<p>x</p>",)], "h string").select(
        page_title("h", "Speiseplan").alias("t"), meta_property("h", "article:modified_time").alias("m"),
        text_lines("h").alias("l"))
    a, b = df.collect()
    assert (a.t, a.m, a.l) == ("Speise & Trank", "2024-05-01T10:00:00+00:00", "Speise & Trank\neins\nzwei\ndrei")
    assert (b.t, b.m, b.l) == ("Speiseplan", "", "x")
