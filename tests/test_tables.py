"""CSV records cut by tasks that begin inside quotes, and many tables transposed at once, against plain Python."""
import csv
import io
import os
import random

import pytest

from offerboard.operators import menus as C
from offerboard.sources import readers as R
from offerboard.sources import sinks as S


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(folder, files, newline):
    os.makedirs(folder)
    want = {}
    for name, rows in files.items():
        out = io.StringIO()
        csv.writer(out, lineterminator=newline).writerows(rows)
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            f.write(out.getvalue())
        want[name] = rows
    return want


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_of_any_split_match_the_csv_module(spark, tmp_dir, tiny_splits, newline):
    rnd = random.Random(1)
    cell = lambda: "".join(rnd.choice(['a', ',', '"', '\n', ' ', 'é', '\u0001', '\u0002', "ab"]) for _ in range(rnd.randint(0, 12)))
    files = {f"t{k}": [["x"] + [cell() for _ in range(3)] for _ in range(rnd.randint(1, 60))] for k in range(4)}
    want = written(f"{tmp_dir}/csv", files, newline)
    got = {}
    for r in R.scan_csv_table(spark, f"{tmp_dir}/csv", header=False).collect():
        got.setdefault(r.file.rpartition("/")[2][:-4], {})[r.row] = r.cells
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == want
    assert all(sorted(v) == list(range(len(v))) for v in got.values())


def test_header_skipped_rows_blank_lines_and_no_last_line_break(spark, tmp_dir, tiny_splits):
    os.makedirs(f"{tmp_dir}/csv")
    with open(f"{tmp_dir}/csv/a.csv", "w") as f:
        f.write('h,"x\ny",z\n0,"a\n\nb",\n\n2,"""q""",c\n3,skip,\n4,,e')
    got = sorted((r.row, r.cells) for r in R.scan_csv_table(spark, f"{tmp_dir}/csv", skip_rows=[3]).collect())
    assert got == [(0, ["0", "a\n\nb", ""]), (2, ["2", '"q"', "c"]), (4, ["4", "", "e"])]
    named = R.csv_table_columns(R.scan_csv_table(spark, f"{tmp_dir}/csv", skip_rows=[3]), ["b", "z"], keep_cols=[1, 5])
    assert sorted((r.row, r.b, r.z) for r in named.collect()) == [(0, "a\n\nb", None), (2, '"q"', None), (4, "", None)]


def test_an_open_quote_takes_the_rest_of_its_file_only(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/csv")
    for name, text in (("a", 'x\n"y\nz\n'), ("b", "p\nq\n"), ("c", "")):
        with open(f"{tmp_dir}/csv/{name}.csv", "w") as f:
            f.write(text)
    got = sorted((r.file[-5], r.record, r.text) for r in R.csv_records(spark, f"{tmp_dir}/csv").collect())
    assert got == [("a", 0, "x"), ("a", 1, '"y\nz'), ("b", 0, "p"), ("b", 1, "q")]


def test_sink_and_scan_agree(spark, tmp_dir):
    rows = [(' a "b"', "x,y"), ("line\nbreak ", '""'), ("", "z")]
    S.csv_sink(spark.createDataFrame(rows, "p string, q string").coalesce(1), f"{tmp_dir}/out")
    assert sorted(tuple(r.cells) for r in R.scan_csv_table(spark, f"{tmp_dir}/out", header=False).collect()) == sorted(rows)


@pytest.mark.parametrize("slots", [4, 10_000])
def test_transpose_against_zip(spark, slots):
    rnd = random.Random(4)
    tables = {(f"t{k}" if k else None): [[rnd.choice(["a", None, ""]) for _ in range(rnd.randint(0, 5))] for _ in range(rnd.randint(1, 11))]
              for k in range(40)}
    rows = [(k, "clash", 3 * i, c if c else (None if i % 2 else [])) for k, t in tables.items() for i, c in enumerate(t)]
    df = spark.createDataFrame(rows, "key string, part string, n int, line array<string>")
    got = {}
    for r in C.transpose_tables(df, ["key"], "n", "line", slots).collect():
        assert len(r.cells) <= slots
        got.setdefault(r.key, {}).setdefault(r.row, {})[r.part] = r.cells
    for key, t in tables.items():
        width = max(map(len, t))
        full = [c + [None] * (width - len(c)) for c in t]
        want = [list(c) for c in zip(*full)]
        parts = got.get(key, {})
        assert [[v for p in sorted(parts[i]) for v in parts[i][p]] for i in sorted(parts)] == want


def test_transpose_is_its_own_inverse(spark):
    rows = [("a", i, [f"{i}.{j}" for j in range(300)]) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, row int, cells array<string>")
    twice = C.transpose_tables(C.transpose_tables(df, ["k"]), ["k"])
    assert sorted((r.k, r.row, r.cells) for r in twice.collect()) == rows
