"""Inputs at the edges: nothing may get lost in silence."""

import datetime as dt
import decimal
import json
import os

from pyspark.sql import functions as F

from offerboard.functions.prices import parse_price, split_desc_price
from offerboard.functions.text import html_unescape, run_order, strip_footnotes
from offerboard.operators import board as B
from offerboard.operators import menus as C
from offerboard.operators import nodes as N
from offerboard.plans import views as V
from offerboard.sources import readers as R
from offerboard.sources import sinks as S
from offerboard.streaming import offers_stream as ST


def test_board_of_new_year(spark, tmp_dir):
    rows = [(1, dt.datetime(2024, 1, 2, 9), "purchase", "a", 1.0), (2, dt.datetime(2024, 12, 30, 9), "view", "b", 2.0),
            (3, dt.datetime(2024, 12, 31, 9), "purchase", "c", 3.0), (4, dt.datetime(2025, 1, 1, 9), "view", "d", 3.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, props string, value double") \
        .write.parquet(f"{tmp_dir}/events.parquet")
    for date in ("2024-12-30", "2025-01-01", "2024-01-02", "2027-01-01"):
        cut, whole = V.board_offers(spark, tmp_dir, date), V.offers(spark, tmp_dir)
        for part in (lambda o: B.week_offers(o, date, "board"), lambda o: B.day_offers(o, date)):
            assert sorted(r.desc for r in part(cut).collect()) == sorted(r.desc for r in part(whole).collect())
    assert [r.desc for r in B.week_offers(V.board_offers(spark, tmp_dir, "2024-12-30"), "2024-12-30", "board").collect()] == ["a"]


def test_every_meal_of_a_day_stays(spark):
    text = "08.01.2024 - 12.01.2024\nMontag\nA 1,00 €\nB 2,00 €\nC 3,00 €"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert sorted(r.desc for r in C.extract_text_menu(docs, keep_empty_days=False).collect()) == ["A", "B", "C"]
    assert sorted(r.desc for r in C.extract_text_menu(docs, max_meals=2, keep_empty_days=False).collect()) == ["A", "B"]


def test_undated_texts_and_rows_are_rejects(spark):
    docs = spark.createDataFrame([(1, "Karte\nMontag\nA 1,00 €"), (2, "08.01.2024 - 12.01.2024\nMontag\nA 1,00 €"),
                                  (3, None), (4, ""), (5, "Montag\n08.01.2024 - 12.01.2024\nA 1,00 €")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.reason) for r in C.text_menu_rejects(docs).collect()) == [
        (1, "no period"), (3, "no text"), (4, "no period"), (5, "no period")]
    assert {r.doc_id for r in C.extract_text_menu(docs).collect()} == {2}
    html = "<p>08.01.2024 - 12.01.2024</p><h4>Dienstag, 09.01.</h4><table><tr><td>A</td><td>1,00 €</td></tr></table>" \
           "<h4>Sonstiges</h4><table><tr><td>B</td><td>2,00 €</td></tr></table>"
    nodes = N.html_nodes(spark.createDataFrame([(1, html)], "page_id bigint, html string"))
    assert [(r.offer_key, r.desc) for r in C.extract_html_menu(nodes, keep_empty_days=False).collect()] == [("2024-01-09", "A")]
    assert [(r.section, r.reason) for r in C.html_menu_rejects(nodes).collect()] == [("Sonstiges", "no weekday")]


def test_settings_of_a_site(spark):
    docs = spark.createDataFrame(
        [(1, "Montag\nA 1,00 €\nB 1,00 €", dt.date(2024, 1, 10), 1, None, None),
         (2, "Karte\nC 2,00 €", dt.date(2024, 1, 10), None, True, None),
         (3, "08.01.2024 - 12.01.2024\nMontag\nD 3,00 €", None, None, None, True)],
        "doc_id bigint, text string, run_date date, max_meals int, all_week boolean, keep_empty boolean")
    got = sorted((r.doc_id, r.offer_key, r.desc or "") for r in C.extract_text_menu(
        docs, keep_empty_days=False, settings=tuple(C.MENU_SETTINGS)).collect())
    assert got == [(1, "2024-01-08", "A"), (2, "2024-W02", "C"), (3, "2024-01-08", "D")] + [
        (3, f"2024-01-{d:02d}", "") for d in (9, 10, 11, 12)]


def test_chunked_sections_keep_null_keys(spark):
    lines = spark.createDataFrame([(1, 0, "Montag"), (1, 5, "a"), (None, 0, "b"), (1, None, "c")], "doc_id long, pos long, line string")
    for chunk in (None, 2):
        assert C.assign_sections(lines, C.heading_word(F.col("line")), chunk=chunk).count() == 4


def test_pages_keep_all_text_and_nodes(spark):
    rows, text = N.parse_nodes("plain <b>x</b> tail")
    assert text == "plain x tail" and [(r[5], text[r[8]:r[9]]) for r in rows] == [("b", "x")]
    rows, text = N.parse_nodes("<div><p>a</p></div><![foo[x]]><p>b</p>")
    assert [r[5] for r in rows] == ["div", "p", "p"] and text == "ab"
    rows, _ = N.parse_nodes("<ul>" + "<li>x" * 3 + "</ul><table><tr><td>1<td>2<tr><td>3</table>")
    assert [r[5] for r in rows] == ["ul", "li", "li", "li", "table", "tr", "td", "td", "tr", "td"]
    assert [r[3] for r in rows] == [0, 1, 1, 1, 0, 1, 2, 2, 1, 2]


def test_texts(spark):
    def all_of(fn, *texts):
        return [r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
                .select("i", fn(F.col("t")).alias("x")).orderBy("i").collect()]
    assert all_of(html_unescape, "K&auml;se &ndash; gr&#252;n &#x1F600;", "a & b &amp;lt; &nope; &#0; &#xD800; &#9999999;", None, "", "&") == [
        "Käse – grün 😀", "a & b &lt; &nope; &#0; &#xD800; &#9999999;", None, "", "&"]
    assert all_of(strip_footnotes, "Coffee to go", "Suppe € 7,70", "Eintopf a,g.i", "Eintopf ag", "Brot 1,12,a") == [
        "Coffee to go", "Suppe € 7,70", "Eintopf", "Eintopf", "Brot"]
    assert all_of(parse_price, "6,90\xa0€", "Braten 1.250,00 €", "2.345.67 €", "x 1a,7,70 €", "7,70€", "6.90 €") == [
        decimal.Decimal(x) if x else None for x in ("6.90", "1250.00", None, "7.70", "7.70", "6.90")]
    assert all_of(lambda c: split_desc_price(c)[0], "Braten 1.250,00 €", "Suppe 6,90\xa0€ x") == ["Braten", "Suppe"]
    assert all_of(run_order, "r10", "r2", None) == sorted(all_of(run_order, "r10", "r2", None), reverse=True)


def test_bad_json_is_a_reject(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/loc")
    for name, body in (("2024-01.json", '{"2024-01-02": []}'), ("2024-02.json", "no json"), ("2024-03.json", "{}")):
        with open(f"{tmp_dir}/loc/{name}", "w") as f:
            f.write(body)
    assert [r.file_path[-12:] for r in R.scan_offers_rejects(spark, tmp_dir).collect()] == ["2024-02.json"]
    assert R.scan_offers(spark, tmp_dir).count() == 1


def test_store_takes_later_runs_only(spark, tmp_dir):
    src, store, ckpt = f"{tmp_dir}/archive", f"{tmp_dir}/store", f"{tmp_dir}/ckpt"
    os.makedirs(f"{src}/loc")

    def arrive(name, doc):
        with open(f"{src}/loc/{name}.json", "w") as f:
            json.dump(doc, f)

    def run():
        ST.run_archive_to_store(spark, src, store, ckpt)
        return sorted((r.file_week, r.desc) for r in ST.stored_offers(spark, store).collect())

    meal = lambda d: {"2024-01-08": [{"desc": d, "price": 1}]}
    arrive("2024-02@r2", meal("two"))
    arrive("2024-02@r10", meal("ten"))
    arrive("2024-03@r2", meal("stays"))
    assert run() == [("2024-02", "ten"), ("2024-03", "stays")]
    arrive("2024-02@r9", meal("late"))
    arrive("2024-03@r3", {})
    assert run() == [("2024-02", "ten")]
    arrive("2024-03@r4", meal("again"))
    assert run() == [("2024-02", "ten"), ("2024-03", "again")]


def test_repeated_run_replaces_its_artifacts(spark, tmp_dir):
    arts = spark.createDataFrame([("x", "raw", "old"), ("y", "raw", "y")], "artifact_name string, kind string, body string")
    for _ in range(2):
        S.write_artifacts(arts, tmp_dir + "/a", "r2")
    S.write_artifacts(arts.filter("artifact_name = 'x'").withColumn("body", F.lit("new")), tmp_dir + "/a", "r10")
    back = spark.read.parquet(tmp_dir + "/a")
    assert back.count() == 3
    assert {(r.artifact_name, r.body) for r in S.latest_artifacts(back).collect()} == {("x", "new"), ("y", "y")}
