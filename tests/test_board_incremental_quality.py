"""Board (D), incremental processing (E) and quality checks (F)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from offerboard.operators import board as B
from offerboard.operators import incremental as E
from offerboard.operators import menus as C
from offerboard.operators import quality as Q

OFFERS = [("a", "2024-01-09", 0, "Suppe", "3.50"), ("a", "2024-01-09", 1, "Schnitzel", "7.90"),
          ("a", "2024-W02", 0, "Pasta", "5.00"), ("b", "2024-01-09", 0, "Eintopf", "4.00"),
          ("c", "2024-W02", 0, "Salat", None), ("a", "2024-01-10", 0, "Fisch", "8.00"),
          ("d", "2024-01-09", None, None, None)]


def _offers(spark):
    df = spark.createDataFrame(OFFERS, "location string, offer_key string, pos bigint, desc string, price_raw string")
    return Q.normalize_price(df)


def _locations(spark):
    return spark.createDataFrame(
        [("a", "A", "https://a", ["x", "y"]), ("b", "B", "https://b", []), ("c", "C", "https://c", ["z"]),
         ("d", "D", "https://d", []), ("e", "E", "https://e", [])], "location string, name string, link string, details array<string>")


def test_board_nested(spark):
    b = {r.location: r for r in B.has_offers(B.board(_offers(spark), _locations(spark), "2024-01-09")).collect()}
    assert [m.desc for m in b["a"].meals.day] == ["Suppe", "Schnitzel"]
    assert [m.desc for m in b["a"].meals.week] == ["Pasta"]
    assert b["c"].meals.day == [] and b["c"].meals.week[0].price is None
    assert b["d"].has_offers is False and b["e"].has_offers is False
    assert B.board(_offers(spark), _locations(spark), None).count() == 0


def test_board_rows_and_summary(spark):
    rows = B.ordered_board_rows(B.board_rows(_offers(spark), "2024-01-09")).collect()
    a = [(r.row_kind, r.text) for r in rows if r.location == "a"]
    assert a == [("label", "Tagesangebot"), ("meal", "Suppe"), ("meal", "Schnitzel"), ("label", "Wochenangebot"),
                 ("meal", "Pasta")]
    assert [(r.row_kind, r.text) for r in rows if r.location == "b"] == [("meal", "Eintopf")]
    s = {r.location: (r.details_label, r.n_day, r.n_week, r.has_offers)
         for r in B.board_summary(_offers(spark), _locations(spark), "2024-01-09").collect()}
    assert s == {"a": ("x, y", 2, 1, True), "b": (None, 1, 0, True), "c": ("z", 0, 1, True),
                 "d": (None, 0, 0, False), "e": (None, 0, 0, False)}
    assert B.board_rows(_offers(spark), None).count() == 0


def test_new_links_and_state(spark):
    links = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    seen = spark.createDataFrame([("u2",)], "url string")
    assert sorted(r.url for r in E.new_links(links, seen).collect()) == ["u1", "u3"]
    assert E.new_links(links, None).count() == 3
    state = spark.createDataFrame([("x", "2026-05-18T09:19:30+00:00"), ("y", "2026-05-24T19:19:31Z")],
                                  "location string, t string").select("location", E.parse_high_water("t").alias("high_water"))
    assert all(r.high_water is not None for r in state.collect())
    items = spark.createDataFrame([("x", dt.datetime(2026, 5, 18, 9, 0)), ("x", dt.datetime(2026, 5, 19)),
                                   ("z", dt.datetime(2026, 1, 1)), ("y", None)], "location string, modified timestamp")
    changed = E.changed_pages(items, state)
    assert sorted((r.location, r.modified.day) for r in changed.collect()) == [("x", 19), ("z", 1)]
    new = {r.location: r.high_water for r in E.advance_state(changed, state).collect()}
    assert new["x"] == dt.datetime(2026, 5, 19) and new["z"] == dt.datetime(2026, 1, 1) and new["y"] is not None


def test_latest_per_week(spark):
    rows = spark.createDataFrame([("a", "2024-01", 1, "old"), ("a", "2024-01", 2, "new"), ("a", "2024-01", 2, "new2"),
                                  ("a", "2024-02", 1, "only")], "location string, file_week string, run_ts int, desc string")
    assert sorted(r.desc for r in E.latest_per_week(rows).collect()) == ["new", "new2", "only"]


def test_quality(spark):
    keys = spark.createDataFrame([("a", "2024-01", "2024-12-30"), ("a", "2024-01", "2024-W53"), ("a", "2023-46", "2023-11-18"),
                                  ("a", "2026-03", "2026-W02"), ("a", "2024-W01", "2024-W01"), ("a", "x", "Montag")],
                                 "location string, file_week string, offer_key string")
    got = {r.offer_key: (r.key_kind, r.is_weekend, r.bad_week, r.week_mismatch) for r in Q.check_keys(keys).collect()}
    assert got == {"2024-12-30": ("day", False, False, True), "2024-W53": ("week", False, True, True),
                   "2023-11-18": ("day", True, False, False), "2026-W02": ("week", False, False, True),
                   "2024-W01": ("week", False, False, False), "Montag": ("other", False, False, False)}
    dup = spark.createDataFrame([("a", "k", "x"), ("a", "k", "x"), ("a", "k", "y")], "location string, offer_key string, desc string")
    assert [(r.desc, r.n) for r in Q.duplicate_meals(dup).collect()] == [("x", 2)]
    a = spark.createDataFrame([("l", "k", 0, "Suppe", Decimal("3.50")), ("l", "k", 1, "Feiertag", None)],
                              "location string, offer_key string, pos bigint, desc string, price decimal(10,2)")
    b = spark.createDataFrame([("l", "k", 0, "Suppe", Decimal("3.80")), ("l", "k", 2, "Neu", None)],
                              "location string, offer_key string, pos bigint, desc string, price decimal(10,2)")
    assert {r.pos: r.status for r in Q.diff_runs(a, b).collect()} == {0: "changed", 1: "removed", 2: "added"}
    only_a, only_b = Q.diff_runs_set(a, b)
    assert only_a.count() == 2 and only_b.count() == 2
    m = Q.run_matrix(spark.createDataFrame([(1,), (2,)], "id int"),
                     [{"provider": "google", "model": "gemini-2.0-flash"}, {"provider": "openai", "model": "gpt-4o"}])
    assert m.count() == 4 and {r.provider for r in m.collect()} == {"google", "openai"}
    u = spark.createDataFrame([("l", "p", "m", 700, 250, 950), ("l", "p", "m", 10, 5, 16)],
                              "location string, provider string, model string, prompt_tokens long, completion_tokens long, total_tokens long")
    r = Q.usage_summary(u).collect()[0]
    assert (r.prompt_tokens, r.total_tokens, r.totals_ok) == (710, 966, False)


def test_menu_table_ops(spark):
    wide = spark.createDataFrame([("Suppe", "Erbsen 2,50 €", None, "", "Tomate 2,50 €", "x")],
                                 "cat string, mon string, tue string, wed string, thu string, fri string")
    assert C.unpivot_week_table(wide, ["cat"], ["mon", "tue", "wed", "thu", "fri"]).count() == 3
    t = C.transpose_table(spark.createDataFrame([(0, "A", "x"), (1, "B", "y")], "k int, n string, m string"), "k", ["n", "m"])
    assert {r.field: (r["0"], r["1"]) for r in t.collect()} == {"n": ("A", "B"), "m": ("x", "y")}
    dated = spark.createDataFrame([("2024-01-08", "Schnitzel 7,50€ mit Beilage", None)], "d string, m1 string, m2 string")
    r = C.dated_rows_to_meals(dated, "d", ["m1", "m2"]).collect()
    assert [(x.desc, x.price) for x in r] == [("Schnitzel", Decimal("7.50"))]
    sides = spark.createDataFrame([(1, "Hähnchen", "Sättigungsbeilage Reis", "Gemüsebeilage Erbsen")], "id int, main string, s1 string, s2 string")
    assert [x.desc for x in C.side_dishes(sides, "main", ["s1", "s2"], keep=["id"]).orderBy("idx").collect()] == [
        "Hähnchen", "Sättigungsbeilage Reis", "Gemüsebeilage Erbsen"]
    wd = spark.range(1).select(C.current_weekdays("2024-01-10").alias("w")).collect()[0].w
    assert wd[0] == dt.date(2024, 1, 8) and wd[-1] == dt.date(2024, 1, 12)


def test_site_rules(spark):
    pages = spark.createDataFrame([(1, "https://www.a.de/x"), (2, "https://b.de/"), (3, "https://m.shop.b.de/"),
                                   (4, "https://c.de/")], "page_id int, url string")
    rules = spark.createDataFrame([("www.a.de", "a", 2, "keep"), ("b.de", "b", None, "drop"), ("shop.b.de", "s", 4, "keep")],
                                  "host string, location string, max_meals int, empty_policy string")
    over = spark.createDataFrame([("www.a.de", 3, None)], "host string, max_meals int, empty_policy string")
    got = {r.page_id: (r.location, r.max_meals, r.empty_policy) for r in C.apply_site_rules(pages, rules, over).collect()}
    assert got == {1: ("a", 3, "keep"), 2: ("b", None, "drop"), 3: ("s", 4, "keep"), 4: (None, None, None)}


def test_today_and_failing_expectation(spark):
    import pytest
    from offerboard.operators import links as L
    today = spark.range(1).select(F.date_format(F.current_date(), "yyyy-MM-dd").alias("d")).collect()[0].d
    offers = spark.createDataFrame([("a", today, 0, "Heute", "1.00")],
                                   "location string, offer_key string, pos bigint, desc string, price_raw string")
    assert [r.text for r in B.board_rows(Q.normalize_price(offers), B.TODAY).collect()] == ["Heute"]
    items = spark.createDataFrame([(1,), (1,), (2,)], "page_id int")
    keys = spark.createDataFrame([(1,), (2,)], "page_id int")
    assert L.expect_count(items, keys, "page_id", "==", 2).filter("accepted").count() == 1
    with pytest.raises(Exception):
        L.expect_count(items, keys, "page_id", "==", 2, fail=True).collect()


def test_changed_sites(spark):
    meta = '<meta property="article:modified_time" content="{}">'
    pages = spark.createDataFrame([(1, "https://a.de/x", meta.format("2026-05-18T09:19:30+00:00")),
                                   (2, "https://b.de/", meta.format("2026-05-20T00:00:00+00:00")),
                                   (3, "https://c.de/", meta.format("kaputt")), (4, "https://d.de/", "<p></p>")],
                                  "page_id int, url string, html string")
    state = spark.createDataFrame([("a.de", "2026-05-18T09:19:30+00:00"), ("b.de", "2026-05-18T09:19:30Z")],
                                  "location string, t string").select("location", E.parse_high_water("t").alias("high_water"))
    assert [r.page_id for r in E.changed_sites(pages, state).collect()] == [2]
    assert sorted(r.page_id for r in E.changed_sites(pages, None).collect()) == [1, 2]


def test_day_week_offers_and_wrap(spark, tmp_dir):
    from offerboard.functions.html import text_lines, wrap_document
    from offerboard.sources.sinks import write_artifacts
    offers = _offers(spark)
    assert sorted(r.desc for r in B.day_offers(offers, "2024-01-09").collect() if r.desc) == ["Eintopf", "Schnitzel", "Suppe"]
    assert sorted(r.desc for r in B.week_offers(offers, "2024-01-09").collect()) == ["Pasta", "Salat"]
    assert B.week_offers(offers, "2024-12-31", "board").count() == 0
    doc = spark.createDataFrame([("<div><h2>Plan</h2><p>Suppe</p></div>", None)], "block string, title string")
    wrapped = doc.select(wrap_document(F.col("block"), F.coalesce(F.col("title"), F.lit("Speiseplan - u"))).alias("d"))
    r = wrapped.select("d", text_lines(F.col("d")).alias("t")).collect()[0]
    assert r.d.startswith("<!doctype html>") and "<title>Speiseplan - u</title>" in r.d
    assert r.t == "Speiseplan - u\nPlan\nSuppe"
    arts = spark.createDataFrame([("x.html", "raw", "<p>x</p>"), ("cleaned_x.html", "cleaned", "x")],
                                 "artifact_name string, kind string, body string")
    write_artifacts(arts, f"{tmp_dir}/arts")
    back = spark.read.parquet(f"{tmp_dir}/arts")
    assert {(r.kind, r.artifact_name) for r in back.collect()} == {("raw", "x.html"), ("cleaned", "cleaned_x.html")}
