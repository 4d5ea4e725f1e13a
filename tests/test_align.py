"""Alignment of two runs: inserted, removed, moved and changed meals; least cost against brute force; hot keys in chunks."""
import random
from functools import lru_cache

import numpy as np
import pytest

from offerboard.operators import align as A

SCHEMA = "location string, offer_key string, pos long, desc string, price decimal(10,2)"


def frame(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(l, k, p, d, None if x is None else Decimal(str(x))) for l, k, p, d, x in rows], SCHEMA)


def statuses(spark, a, b, **more):
    return sorted((r.location or "", r.offer_key or "", r.status, -9 if r.a_pos is None else r.a_pos, -9 if r.b_pos is None else r.b_pos)
                  for r in A.align_runs(frame(spark, a), frame(spark, b), **more).collect())


def meals(names, start=0, key="k"):
    return [("x", key, i + start, n, 5) for i, n in enumerate(names)]


def test_one_inserted_meal_is_one_added(spark):
    got = statuses(spark, meals("abcd"), meals("Nabcd"))
    assert [g[2] for g in got] == ["added", "same", "same", "same", "same"]


def test_removed_moved_and_changed(spark):
    a = meals("abcdefgh")
    b = [("x", "k", i, n, 6 if n == "e" else 5) for i, n in enumerate("bcdefga")]      # a moved, h removed
    b[2] = ("x", "k", 2, "D", 5)                                                       # d renamed, price kept
    b[6] = ("x", "k", 6, "a", 7)                                                       # a also changed: no move, but gone and new
    got = {(s, p, q) for _, _, s, p, q in statuses(spark, a, b)}
    assert got == {("removed", 0, -9), ("same", 1, 0), ("same", 2, 1), ("desc", 3, 2), ("price", 4, 3), ("same", 5, 4),
                   ("same", 6, 5), ("removed", 7, -9), ("added", -9, 6)}
    b[6] = ("x", "k", 6, "a", 5)
    last = ("x", "k", 9, "z", 1)
    got = {(s, p, q) for _, _, s, p, q in statuses(spark, a[:7] + [last], b[:6] + [last, ("x", "k", 10, "a", 5)])}
    assert got == {("moved", 0, 10), ("same", 1, 0), ("same", 2, 1), ("desc", 3, 2), ("price", 4, 3), ("same", 5, 4),
                   ("same", 6, 5), ("same", 9, 9)}


def test_nulls_repeats_and_empty_days(spark):
    a = [("x", None, 1, None, None), ("x", None, 2, "a", None), ("x", "d", None, None, None), ("y", "k", 1, "r", 1), ("y", "k", 2, "r", 1)]
    b = [("x", None, 5, None, None), ("x", None, 6, "a", 2), ("y", "k", 1, "r", 1), ("y", "k", 2, "r", 1), ("y", "k", 3, "r", 1)]
    got = [g[:3] for g in statuses(spark, a, b)]
    assert got == [("x", "", "price"), ("x", "", "same"), ("y", "k", "added"), ("y", "k", "same"), ("y", "k", "same")]
    assert statuses(spark, [], []) == [] and [g[2] for g in statuses(spark, a[:1], [])] == ["removed"]


@pytest.mark.parametrize("chunk", [3, 100_000])
def test_chunks_do_not_change_the_answer(spark, chunk):
    rnd = random.Random(2)
    names = [f"m{i}" for i in range(200)]
    other = [n for n in names if rnd.random() > 0.1]
    other.insert(40, "new")
    other.append(other.pop(10))
    got = statuses(spark, meals(names), meals(other, 1000), chunk=chunk)
    kinds = {s: sum(g[2] == s for g in got) for s in {g[2] for g in got}}
    assert kinds == {"same": len(other) - 2, "moved": 1, "added": 1, "removed": len(names) - len(other) + 1}


def test_a_meal_that_moves_beyond_the_band_anchors_nothing(spark):
    names = [f"m{i}" for i in range(60)]
    got = statuses(spark, meals(names), meals(names[1:] + names[:1]), band=5)
    assert sorted(g[2] for g in got) == ["moved"] + ["same"] * 59


def least(a, b):
    @lru_cache(None)
    def cost(i, j):
        if i == len(a) or j == len(b):
            return 2 * (len(a) - i + len(b) - j)
        d, p = a[i][0] == b[j][0], a[i][1] == b[j][1]
        pair = 0 if d and p else 1 if d else 3 if p else 4
        return min(pair + cost(i + 1, j + 1), 2 + cost(i + 1, j), 2 + cost(i, j + 1))
    return cost(0, 0)


@pytest.mark.parametrize("cells", [1 << 22, 6])
def test_least_cost_against_brute_force(monkeypatch, cells):
    monkeypatch.setattr(A, "CELLS", cells)
    rnd = random.Random(3)
    for _ in range(300):
        a, b = ([(rnd.choice("abcd"), rnd.choice([None, 1, 2])) for _ in range(rnd.randint(0, 9))] for _ in range(2))
        x, y = A.pair_costs(a, b)
        pairs = A.align(x, y)
        assert all(i < k and j < l for (i, j), (k, l) in zip(pairs, pairs[1:]))
        paid = sum(int(A._pair(x[i], y[j:j + 1])[0]) for i, j in pairs) + 2 * (len(a) + len(b) - 2 * len(pairs))
        assert paid == least(tuple(a), tuple(b))


def test_running_matches_a_plain_window(spark):
    from pyspark.sql import functions as F
    rnd = np.random.default_rng(1)
    rows = [("k" if i % 3 else None, i, int(rnd.integers(0, 99)) if i % 4 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, pos long, v long")
    for how, include in (("max", True), ("max", False), ("sum", True), ("sum", False)):
        got = {r.pos: r.out for r in A.running(df, ["k"], "pos", F.col("v"), "out", how, 7, include).collect()}
        for k, i, _ in rows:
            before = [v for kk, j, v in rows if kk == k and v is not None and (j < i or (include and j == i))]
            assert got[i] == ((max if how == "max" else sum)(before) if before else None)
