"""F4 as sequence alignment: the meals of one key in two runs, aligned by least cost.

A position join calls every meal behind an inserted one changed. Here the two
meal lists of a key are aligned like the lines of two texts:

1. *Anchors* are meals that occur once in each run under a key, with equal
   description and price. Their ranks in both runs are compared. Moved meals
   shift the ranks of all behind them, so a stretch of ``band`` anchors has a
   usual shift of its own; an anchor off it by more than ``band`` has moved and
   anchors nothing, nor does a stretch that moved as a whole (one outside the
   longest row of stretches that lie in the same order in both runs).
2. Anchors that no other anchor crosses belong to every longest common
   subsequence. They cut each key into segments.
3. Each segment is aligned on its own by dynamic programming over the cost
   of a changed price, a changed description, an added and a removed meal.
4. What one segment lost and another one gained unchanged has moved.

Steps 1, 2 and 4 are joins, aggregates and windows; a window that could hold a
hot key's rows runs in two phases over chunks of positions (``running``), so no
key is one task. Step 3 sees what is left of one segment at a time, its
differences, and needs memory linear in them.
"""

from __future__ import annotations

import sys
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerboard.session import materialize

# cost of an aligned pair that differs in its price, in its description, and of a meal that one run lacks
COSTS = {"price": 1, "desc": 3, "gap": 2}
CELLS = 1 << 22          # cells of a cost table that is held at once; larger segments are halved first


def running(df: DataFrame, keys, order: str, value: Column, out: str, how: str = "max", chunk: int = 100_000,
            include: bool = True) -> DataFrame:
    """A running max or sum per key without one task per key.

    A window per (key, chunk of positions) gives the local part. One row a
    chunk carries what came before it, which an equi-join adds. ``include``
    counts the row itself. Keys compare null-safe, positions are not NULL.
    """
    agg = {"max": F.max, "sum": F.sum}[how]
    keys = list(keys)
    part = df.withColumn("_v", value).withColumn("_chunk", F.floor(F.col(order) / chunk).cast("bigint"))
    ends = part.groupBy(*keys, "_chunk").agg(agg("_v").alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_c"),
                        agg("_end").over(before).alias("_carry"))
    local = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if include else -1)
    on = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)] + [F.col("_chunk") == F.col("_c")]
    both = part.withColumn("_local", agg("_v").over(local)).join(carry, on)
    total = F.greatest("_local", "_carry") if how == "max" else \
        F.when(F.col("_local").isNotNull() | F.col("_carry").isNotNull(),
               F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0)))
    return both.select(*df.columns, total.alias(out))


def pair_costs(a: list[tuple], b: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the descriptions and prices of two meal lists; equal numbers are equal values (None equals None)."""
    codes: dict = {}
    number = lambda x: codes.setdefault(x, len(codes))
    return (np.array([[number(("d", d)), number(("p", p))] for d, p in a], np.int64).reshape(-1, 2),
            np.array([[number(("d", d)), number(("p", p))] for d, p in b], np.int64).reshape(-1, 2))


def _last_row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least cost of aligning all of ``a`` with each prefix of ``b``."""
    gap = COSTS["gap"]
    steps = gap * np.arange(len(b) + 1)
    row = steps.copy()
    for x in a:
        row = _next_row(row, x, b, gap, steps)
    return row


def _pair(x: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cost of aligning one meal with each of ``b``; a pair that shares nothing costs as much as two gaps."""
    same = b == x
    return np.where(same[:, 0], np.where(same[:, 1], 0, COSTS["price"]), np.where(same[:, 1], COSTS["desc"], 2 * COSTS["gap"]))


def _next_row(row, x, b, gap, steps):
    best = np.append(row[0] + gap, np.minimum(row[1:] + gap, row[:-1] + _pair(x, b)))
    # gaps along the row: the least of all cells before plus their steps
    return np.minimum.accumulate(best - steps) + steps


def align(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Aligned (i, j) of two meal lists at least cost (any of equal ones, the same one each time).

    Memory is linear in the lists: a large cost table is halved at the row
    where a best path crosses the middle, and both halves are solved alone.
    """
    lead = 0
    while lead < min(len(a), len(b)) and (a[lead] == b[lead]).all():
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and (a[len(a) - 1 - tail] == b[len(b) - 1 - tail]).all():
        tail += 1
    out = [(i, i) for i in range(lead)]
    out += [(i + lead, j + lead) for i, j in _table(a[lead:len(a) - tail], b[lead:len(b) - tail])]
    return out + [(len(a) - t, len(b) - t) for t in range(tail, 0, -1)]


def _table(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    if not len(a) or not len(b):
        return []
    if (len(a) + 1) * (len(b) + 1) > CELLS and len(a) > 1:
        mid = len(a) // 2
        cost = _last_row(a[:mid], b) + _last_row(a[mid:][::-1], b[::-1])[::-1]
        cut = int(cost.argmin())
        return _table(a[:mid], b[:cut]) + [(i + mid, j + cut) for i, j in _table(a[mid:], b[cut:])]
    gap = COSTS["gap"]
    steps = gap * np.arange(len(b) + 1)
    rows = [steps.copy()]
    for x in a:
        rows.append(_next_row(rows[-1], x, b, gap, steps))
    i, j, out = len(a), len(b), []
    while i and j:
        pair = _pair(a[i - 1], b[j - 1:j])[0]
        if pair < 2 * gap and rows[i][j] == rows[i - 1][j - 1] + pair:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[i][j] == rows[i - 1][j] + gap:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _align_segment(table: pa.Table) -> pa.Table:
    """The meals of one segment: every meal once, aligned ones in one row."""
    run, pos = table.column("run").to_pylist(), table.column("pos").to_pylist()
    meal = list(zip(table.column("desc").to_pylist(), table.column("price").to_pylist()))
    sides = [sorted((pos[i], i) for i in range(len(run)) if run[i] == r) for r in "ab"]
    pairs = align(*pair_costs(*[[meal[i] for _, i in s] for s in sides]))
    left, right = [sides[0][i][1] for i, _ in pairs], [sides[1][j][1] for _, j in pairs]
    alone_a = sorted({i for _, i in sides[0]} - set(left))
    alone_b = sorted({i for _, i in sides[1]} - set(right))
    at_a = pa.array(left + alone_a + [None] * len(alone_b), pa.int64())
    at_b = pa.array(right + [None] * len(alone_a) + alone_b, pa.int64())
    keys = [c for c in table.column_names if c.startswith("_k")]
    first = pa.array([0] * len(at_a), pa.int64())
    take = lambda c, at: table.column(c).combine_chunks().take(at)
    return pa.table([take(k, first) for k in keys] + [take(c, at) for at in (at_a, at_b) for c in ("pos", "desc", "price")],
                    names=keys + [f"{s}_{c}" for s in "ab" for c in ("pos", "desc", "price")])


def rising(values) -> list[int]:
    """Places of a longest strictly rising subsequence."""
    ends, last, before = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(ends, v)
        ends[k:k + 1], last[k:k + 1] = [v], [i]
        before.append(last[k - 1] if k else -1)
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _in_order(table: pa.Table) -> pa.Table:
    """The stretches of one key that lie in the same order in both runs."""
    table = table.sort_by("_stretch")
    return table.take(pa.array(rising(table.column("_place").to_pylist()), pa.int64()))


def steady_anchors(ranked: DataFrame, own, band: int) -> DataFrame:
    """Anchors (own..., pa, pb, ra, rb) that keep step with those around them -> (own..., pa, pb).

    What is decided for a key holds one row a stretch; the anchors of a key
    with a single stretch all stay.
    """
    own = list(own)
    step = ranked.withColumn("_stretch", F.floor((F.col("ra") - 1) / band).cast("bigint"))
    usual = step.groupBy(*own, "_stretch").agg(F.median(F.col("rb") - F.col("ra")).alias("_usual"))
    usual = usual.withColumn("_place", F.col("_stretch") * band + F.col("_usual")) \
        .withColumn("_last", F.max("_stretch").over(Window.partitionBy(*own)))
    usual = materialize(usual, "align-stretches")
    several = usual.where("_last > 0")
    kept = several.groupBy(*own).applyInArrow(lambda t: _in_order(t), several.schema).unionByName(usual.where("_last = 0"))
    line = kept.select(*[F.col(o).alias(f"_s{o}") for o in own], F.col("_stretch").alias("_s"), "_usual", "_last")
    on = [F.col(o).eqNullSafe(F.col(f"_s{o}")) for o in own] + [F.col("_stretch") == F.col("_s")]
    return step.join(line, on).where((F.col("_last") == 0) | (F.abs(F.col("rb") - F.col("ra") - F.col("_usual")) <= band)) \
        .select(*own, "pa", "pb")


def align_runs(a: DataFrame, b: DataFrame, keys=("location", "offer_key"), band: int = 1000, chunk: int = 100_000) -> DataFrame:
    """meals of two runs (keys..., pos, desc, price), aligned per key.

    -> (keys..., status, a_pos, a_desc, a_price, b_pos, b_desc, b_price) with
    status ``same``, ``price`` or ``desc`` (what changed), ``added``,
    ``removed`` or ``moved``. Rows without a position (empty days) are no
    meals; positions are distinct within a key and run. NULL keys are a key,
    NULL descriptions and prices equal NULL ones. Of a key's equal meals that
    moved, the first lost one meets the first gained one.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    keys = list(keys)
    own = [f"_k{i}" for i in range(len(keys))]
    meal = ["desc", "price"]
    prices = a.schema["price"].dataType.simpleString()
    take = lambda df, run: df.where(F.col("pos").isNotNull()).select(
        *[F.col(k).alias(o) for k, o in zip(keys, own)], F.lit(run).alias("run"), F.col("pos").cast("bigint").alias("pos"),
        F.col("desc").cast("string").alias("desc"), F.col("price").cast(prices).alias("price"))
    both = materialize(take(a, "a").unionByName(take(b, "b")), "align-runs")

    # 1. anchors: one aggregate over both runs, combined before the shuffle
    count = lambda r: F.count(F.when(F.col("run") == r, 1))
    at = lambda r: F.max(F.when(F.col("run") == r, F.col("pos")))
    anchors = (both.groupBy(*own, *meal).agg(count("a").alias("n"), count("b").alias("m"), at("a").alias("pa"), at("b").alias("pb"))
               .where("n = 1 and m = 1").select(*own, "pa", "pb"))
    # each step reads the one before twice (chunks and what they carry), so each is written once
    by_a = materialize(running(materialize(anchors, "align-anchors"), own, "pa", F.lit(1), "ra", "sum", chunk), "align-ranks")
    ranked = running(by_a, own, "pb", F.lit(1), "rb", "sum", chunk)
    steady = materialize(steady_anchors(materialize(ranked, "align-ranked"), own, band), "align-steady")
    # 2. no anchor before it lies behind it in the other run, none behind it before
    forth = materialize(running(steady, own, "pa", F.col("pb"), "most", "max", chunk, include=False), "align-forth")
    back = running(forth.withColumn("_down", -F.col("pa")), own, "_down", -F.col("pb"), "least", "max", chunk, include=False)
    cuts = materialize(back.where((F.col("most").isNull() | (F.col("most") < F.col("pb")))
                      & (F.col("least").isNull() | (-F.col("least") > F.col("pb")))).select(*own, "pa", "pb"), "align-cuts")
    # every other meal belongs to the segment of the last cut before it
    marks = cuts.select(*own, F.lit("a").alias("run"), F.col("pa").alias("pos"), F.col("pa").alias("cut"), "pb").unionByName(
        cuts.select(*own, F.lit("b").alias("run"), F.col("pb").alias("pos"), F.col("pa").alias("cut"), "pb"))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in own] + [F.col("l.run") == F.col("r.run"), F.col("l.pos") == F.col("r.pos")]
    marked = materialize(both.alias("l").join(marks.alias("r"), on, "left").select("l.*", "r.cut", "r.pb"), "align-marked")
    parts = materialize(running(marked, [*own, "run"], "pos", F.col("cut"), "segment", "max", chunk), "align-parts")
    fixed = parts.where("cut is not null and run = 'a'").select(
        *own, F.col("pos").alias("a_pos"), F.col("desc").alias("a_desc"), F.col("price").alias("a_price"),
        F.col("pb").alias("b_pos"), F.col("desc").alias("b_desc"), F.col("price").alias("b_price"), F.lit("same").alias("status"))

    # 3. what lies between two cuts
    schema = ", ".join([f"{o} {a.schema[k].dataType.simpleString()}" for k, o in zip(keys, own)]
                       + [f"{s}_{c} {t}" for s in "ab" for c, t in (("pos", "bigint"), ("desc", "string"), ("price", prices))])
    between = parts.where("cut is null").drop("cut", "pb").groupBy(*own, "segment").applyInArrow(lambda t: _align_segment(t), schema)
    status = (F.when(F.col("b_pos").isNull(), "removed").when(F.col("a_pos").isNull(), "added")
              .when(~F.col("a_desc").eqNullSafe(F.col("b_desc")), "desc")
              .when(~F.col("a_price").eqNullSafe(F.col("b_price")), "price").otherwise("same"))
    aligned = materialize(between.withColumn("status", status), "align-segments")

    # 4. lost here and gained there
    alone = aligned.where(F.col("status").isin("added", "removed"))
    side = F.when(F.col("status") == "added", "b").otherwise("a")
    loose = materialize(alone.select(*own, side.alias("run"), F.coalesce("a_pos", "b_pos").alias("pos"),
                         F.when(side == "a", F.col("a_desc")).otherwise(F.col("b_desc")).alias("desc"),
                         F.when(side == "a", F.col("a_price")).otherwise(F.col("b_price")).alias("price")), "align-loose")
    nth = running(loose, [*own, *meal, "run"], "pos", F.lit(1), "nth", "sum", chunk)
    ends = nth.groupBy(*own, *meal, "nth").agg(*[F.max(F.when(F.col("run") == r, F.col("pos"))).alias(f"{r}_pos") for r in "ab"])
    pick = lambda r, c: F.when(F.col(f"{r}_pos").isNotNull(), F.col(c)).alias(f"{r}_{c}")
    moved = ends.select(*own, "a_pos", pick("a", "desc"), pick("a", "price"), "b_pos", pick("b", "desc"), pick("b", "price")) \
        .withColumn("status", F.when(F.col("b_pos").isNull(), "removed").when(F.col("a_pos").isNull(), "added").otherwise("moved"))
    out = fixed.unionByName(aligned.where(~F.col("status").isin("added", "removed"))).unionByName(moved)
    return out.select(*[F.col(o).alias(k) for k, o in zip(keys, own)], "status", "a_pos", "a_desc", "a_price", "b_pos", "b_desc", "b_price")
