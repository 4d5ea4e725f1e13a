"""Rules that reach the extraction: layers and domains, typed settings; sections carried over chunks of lines; notices."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from offerboard.operators import menus as C

LISTS = "array<string>"


def test_layers_and_domains(spark):
    pages = spark.createDataFrame([(1, "https://a.b.org/x"), (2, "http://B.ORG"), (3, "https://c.net/"), (4, None), (None, "https://a.b.org/")],
                                  "page_id long, url string")
    base = spark.createDataFrame([("b.org", 3, True, ["x"]), ("a.b.org", None, False, None)], f"host string, max_meals int, keep_empty boolean, notices {LISTS}")
    over = spark.createDataFrame([("b.org", 5, "yes"), ("c.net", None, "2024-01-08")], "host string, max_meals int, run_date string") \
        .withColumn("run_date", F.col("run_date").try_cast("date"))
    got = {r.page_id: r for r in C.site_settings(pages, [base, over]).collect()}
    assert got[1] == got[None].__class__(*[1, "https://a.b.org/x", None, 5, None, False, None, None, ["x"], None])
    assert (got[2].max_meals, got[2].keep_empty) == (5, True) and got[3].run_date == dt.date(2024, 1, 8)
    assert got[4].max_meals is None and (got[None].max_meals, got[None].keep_empty) == (5, False)
    with pytest.raises(ValueError):
        C.site_settings(pages, [base.withColumnRenamed("max_meals", "most")])


def test_sections_do_not_depend_on_chunks(spark):
    rnd = random.Random(5)
    days = ["Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag"]
    texts = []
    for i in range(12):
        lines = ["08.01.2024 - 12.01.2024"] + [rnd.choice(days) if rnd.random() < 0.15 else f"Gericht {j} {rnd.randint(2, 9)},50 €"
                                               for j in range(rnd.randint(0, 60))]
        texts.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(texts + [(None, texts[3][1]), (99, None), (98, "")], "doc_id long, text string")
    want = sorted(map(str, C.extract_text_menu(docs, max_meals=4).collect()))
    assert want == sorted(map(str, C.extract_text_menu(docs, max_meals=4, chunk=3).collect())) and len(want) > 60


def test_one_long_text_is_the_work_of_many_tasks(spark):
    lines = 40_000
    text = "08.01.2024 - 12.01.2024\nMontag\n" + "\n".join(f"Suppe {i} 2,50 €" for i in range(lines))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    out = C.extract_text_menu(docs, keep_empty_days=False, chunk=1000)
    assert out.where("offer_key = '2024-01-08' and price = 2.50").count() == lines
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [last(" in line]
    assert windows and all("_chunk" in line for line in windows)


@pytest.mark.parametrize("line, notice", [
    ("Feiertagsbraten 8,90 €", False), ("Feiertagsbraten", False), ("Am Feiertag geschlossen", True), ("Wir wünschen guten Appetit", True),
    ("Verwünschtes Huhn", False), ("Heute kein separates Gericht", True), ("Feiertag 5,00 €", False), (None, False), ("", False)])
def test_notices_are_words_of_lines_without_a_price(spark, line, notice):
    df = spark.createDataFrame([(line,)], "line string")
    assert C.flag_notices(df).first().is_notice is notice


def test_given_patterns_and_words(spark):
    df = spark.createDataFrame([("Ruhetag", ["Ruhetag"], ["alt"]), ("wünscht", ["Ruhetag"], ["alt"]), ("ALT", None, ["alt"]), ("Oder", None, None),
                                ("wünscht", None, None)], f"line string, n {LISTS}, s {LISTS}")
    assert [r.is_notice for r in C.flag_notices(df, patterns="n").collect()] == [True, False, False, False, True]
    assert [r.line for r in C.split_alternatives(df, words="s").collect()] == ["Ruhetag", "wünscht", "wünscht"]
    assert [r.is_notice for r in C.flag_notices(df, patterns=()).collect()] == [False] * 5
