"""The two golden pairs: a text menu and an HTML menu must be reproduced exactly."""

import decimal
import json
import os

from conftest import FIXTURES
from offerboard.operators import menus, nodes


def _doc(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.offer_key, -1 if r.pos is None else r.pos)):
        lst = out.setdefault(r.offer_key, [])
        if r.pos is not None:
            lst.append({"desc": r.desc, "price": r.price})
    return out


def _expected(name):
    with open(os.path.join(FIXTURES, name), encoding="utf-8") as f:
        return json.load(f, parse_float=decimal.Decimal)


def test_text_menu_golden(spark):
    text = open(os.path.join(FIXTURES, "menu_text.txt"), encoding="utf-8").read()
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert _doc(menus.extract_text_menu(docs, max_meals=2).collect()) == _expected("menu_text_expected.json")


def test_html_menu_golden(spark):
    html = open(os.path.join(FIXTURES, "menu_html.html"), encoding="utf-8").read()
    pages = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    got = _doc(menus.extract_html_menu(nodes.html_nodes(pages)).collect())
    assert got == _expected("menu_html_expected.json")


def test_nested_document_round_trip(spark):
    text = open(os.path.join(FIXTURES, "menu_text.txt"), encoding="utf-8").read()
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    nested = menus.nest_offers(menus.extract_text_menu(docs, max_meals=2))
    doc = menus.offers_document(nested.drop("part")).collect()[0]["offers"]
    as_json = {k: [{"desc": m["desc"], "price": m["price"]} for m in v] for k, v in doc.items()}
    assert as_json == _expected("menu_text_expected.json")


def test_drop_empty_days(spark):
    text = open(os.path.join(FIXTURES, "menu_text.txt"), encoding="utf-8").read()
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    kept = menus.drop_empty_days(menus.extract_text_menu(docs))
    assert "2024-01-01" not in {r.offer_key for r in kept.collect()}


def test_heading_line_with_meal(spark):
    text = "Mittagstisch\n08.01.2024 - 12.01.2024\nMontag: Erbsensuppe 3,50 €\nBrot 1,00 €\nDienstag – Ruhetag\nMittwoch\nEintopf 4,20 €"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = _doc(menus.extract_text_menu(docs, max_meals=None).collect())
    assert got == {"2024-01-08": [{"desc": "Erbsensuppe", "price": decimal.Decimal("3.50")},
                                  {"desc": "Brot", "price": decimal.Decimal("1.00")}],
                   "2024-01-09": [], "2024-01-10": [{"desc": "Eintopf", "price": decimal.Decimal("4.20")}],
                   "2024-01-11": [], "2024-01-12": []}


def test_period_and_document_price_operators(spark):
    import datetime as dt
    text = open(os.path.join(FIXTURES, "menu_text.txt"), encoding="utf-8").read()
    lines = menus.to_lines(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
    assert menus.document_period(lines).collect()[0].week_start == dt.date(2024, 1, 1)
    heads = menus.assign_sections(lines, menus.heading_word(lines["line"]))
    first = heads.filter("is_heading").groupBy("doc_id").agg({"pos": "min"}).withColumnRenamed("min(pos)", "first_heading_pos")
    price = menus.document_price(heads.join(first, "doc_id")).collect()[0].doc_price
    assert price == decimal.Decimal("7.90")
