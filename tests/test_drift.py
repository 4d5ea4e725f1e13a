"""Anchors of two runs whose ranks drift apart: moved meals shift all behind them, blocks move as a whole."""
from offerboard.operators import align as A


def kept(spark, b, n, band):
    at = {m: i for i, m in enumerate(b)}
    rows = [("k", m, at[m], m + 1, at[m] + 1) for m in range(n)]
    df = spark.createDataFrame(rows, "_k0 string, pa long, pb long, ra long, rb long")
    return {r.pa for r in A.steady_anchors(df, ["_k0"], band).collect()}


def test_anchors_behind_many_moved_meals_still_anchor(spark):
    moved = list(range(0, 60, 5))          # 12 of them, more than the band
    got = kept(spark, [m for m in range(100) if m not in moved] + moved, 100, 5)
    assert not got & set(moved[:10]) and set(range(61, 100)) <= got


def test_a_block_that_moved_leaves_the_others_as_anchors(spark):
    got = kept(spark, list(range(30, 120)) + list(range(30)), 120, 5)
    assert got == set(range(30, 120))


def test_rising():
    assert A.rising([]) == [] and A.rising([3, 1, 2, 2, 5, 0, 4]) == [1, 3, 6]
