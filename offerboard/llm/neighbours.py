"""Approximate nearest neighbours with balanced posting lists (operator 4).

A bounded sample is halved again and again at the median along its main
difference, so that all leaves are equally full; the leaves' centres are the
centroids. Every vector goes to its nearest centroid's posting list, boundary
vectors to several. Centroids are searched through an in-memory neighbour
graph; a query visits the lists whose centroid is near enough compared with the
nearest one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, ship, stored
from .vectors import matrix, unit, usable

ship(__name__)

SAMPLE = 20_000          # distinct vectors that centroids are learned from: those of the smallest hash
POSTING = 256            # vectors a posting list should hold
MOST_LISTS = 4096        # posting lists at most: the graph that every task holds is bounded by them
COPIES = 4               # lists that a boundary vector goes to at most
CLOSE = 1.08             # a vector also goes to lists whose centroid is at most so many times as far as the nearest
REACH = 1.35             # a query visits lists whose centroid is at most so many times as far as the nearest
BLOCK = 4096             # vectors of a list scored in one piece of work
DEGREE = 16              # edges of a centroid in the graph


def balanced_centres(x: np.ndarray, leaves: int, seed: int) -> np.ndarray:
    """Unit centres of ``leaves`` (a power of two) equal parts: halved at the median between two means."""
    rng = np.random.default_rng(seed)
    parts = [np.arange(len(x))]
    while len(parts) < leaves:
        halves = []
        for at in parts:
            if len(at) < 2:
                halves.append(at)
                continue
            y = x[at]
            two = y[rng.choice(len(y), 2, replace=False)]
            for _ in range(8):
                side = y @ (two[0] - two[1])
                up = side > np.median(side)
                if up.all() or not up.any():
                    break
                two = np.stack([y[up].mean(0), y[~up].mean(0)])
            order = np.argsort(y @ (two[0] - two[1]), kind="stable")
            halves += [at[order[:len(at) // 2]], at[order[len(at) // 2:]]]
        parts = halves
    centres = np.stack([x[at].mean(0) for at in parts if len(at)])
    size = np.sqrt((centres * centres).sum(1, keepdims=True))
    return centres / np.maximum(size, 1e-12)


class CentroidGraph:
    """Neighbour graph over centroids with best-first search for many points at once."""

    def __init__(self, centres: np.ndarray, degree: int = DEGREE, seed: int = 0):
        self.centres = centres
        n = len(centres)
        rng = np.random.default_rng(seed)
        near = []
        for i in range(0, n, 512):        # blocks keep the similarity matrix small
            s = centres[i:i + 512] @ centres.T
            near.append(np.argsort(-s, axis=1, kind="stable")[:, 1:degree + 1])
        # a few far edges keep every part of the graph within reach
        self.edges = np.concatenate([np.concatenate(near), rng.integers(0, n, (n, 4))], 1)
        self.entries = np.sort(rng.choice(n, min(n, max(1, int(math.sqrt(n)))), replace=False))

    def search(self, x: np.ndarray, width: int, steps: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids found for each row, and their distances, nearest first."""
        n, width = len(self.centres), min(width, len(self.centres))
        seen = np.full((len(x), n), np.inf)
        done = np.zeros((len(x), n), bool)
        rows = np.arange(len(x))[:, None]
        seen[:, self.entries] = self._far(x, np.broadcast_to(self.entries, (len(x), len(self.entries))))
        for _ in range(max(steps, width)):
            edge = np.partition(seen, width - 1, axis=1)[:, width - 1]
            open_ = np.where(done, np.inf, seen)
            pick = np.argpartition(open_, min(3, n - 1), axis=1)[:, :4]
            value = open_[rows, pick]
            live = np.flatnonzero((value <= edge[:, None]).any(1) & np.isfinite(value).any(1))
            if not len(live):
                break
            done[live[:, None], pick[live]] = True
            to = self.edges[pick[live]].reshape(len(live), -1)
            seen[live[:, None], to] = self._far(x[live], to)
        best = np.argpartition(seen, width - 1, axis=1)[:, :width]
        order = np.argsort(seen[rows, best], axis=1, kind="stable")
        best = best[rows, order]
        return best, seen[rows, best]

    def _far(self, x: np.ndarray, to: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ikj->ik", x, self.centres[to]), 0))


def posting_lists(graph: CentroidGraph, x: np.ndarray) -> list[np.ndarray]:
    """Lists of every row: the nearest, and near ones that no chosen list's centroid covers."""
    near, far = graph.search(x, 4 * COPIES)
    out = []
    for lists, d in zip(near, far):
        chosen = [lists[0]]
        for c, dist in zip(lists[1:], d[1:]):
            if len(chosen) >= COPIES or dist > CLOSE * d[0] or not np.isfinite(dist):
                break
            gap = graph.centres[chosen] - graph.centres[c]
            if (np.sqrt((gap * gap).sum(1)) > dist).all():
                chosen.append(c)
        out.append(np.array(chosen, np.int32))
    return out


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5,
            reach: float = REACH, seed: int = 3) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of largest cosine found for each row whose id ``every`` divides.

    All other rows are candidates, whatever their list. Ties go to the smaller
    id; fewer candidates give fewer rows. Vectors that are null, zero, hold
    null or non-finite components, or differ in dimension from most, take no
    part. Repeated rows of one id count once.

    Equal vectors are one entry with their k + 1 smallest ids: no result needs
    more, so an embedding that a third of all rows share is one entry. Lists
    longer than BLOCK are scored in blocks by separate tasks. The sample and
    the centroids are the only data on the driver, bounded by SAMPLE and
    MOST_LISTS.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)
    valid = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull() & usable(vector_col if vector_col == "v" else "v"))
    common = valid.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = common["dim"] if common else 0
    valid = stored(valid.where(F.size("v") == dim).dropDuplicates(["id", "v"]), "valid")
    order = Window.partitionBy("v").orderBy("id")
    first = valid.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    entries = stored(first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                     .select(F.col("ids")[0].alias("rep"), "ids", "v"), "entries")
    n = entries.count()
    asked = valid.where(F.col("id") % every == 0)
    schema = f"query_id {kind[id_col]}, rank int, {id_col} {kind[id_col]}, score double"
    if not n:
        return spark.createDataFrame([], schema)
    sample = entries.select("v", F.xxhash64("rep").alias("mark"), "rep").orderBy("mark", "rep").limit(SAMPLE).select("v").toArrow()
    leaves = 1 << max(0, min(int(math.log2(MOST_LISTS)), math.ceil(math.log2(max(1, n / POSTING)))))
    centres = balanced_centres(unit(matrix(sample.column(0))), min(leaves, 1 << int(math.log2(len(sample)))), seed)
    graph = spark.sparkContext.broadcast(CentroidGraph(centres))

    def assign(batches):
        g = graph.value
        for b in batches:
            for i in range(0, b.num_rows, 256):
                s = b.slice(i, 256)
                lists = posting_lists(g, unit(matrix(s.column(1))))
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(lists, pa.list_(pa.int32()))],
                                                 names=["rep", "v", "lists"])

    def visit(batches):
        g = graph.value
        for b in batches:
            for i in range(0, b.num_rows, 256):
                s = b.slice(i, 256)
                near, far = g.search(unit(matrix(s.column(1))), len(g.centres))
                lists = [c[d <= max(reach * d[0], 1e-9)].astype(np.int32) for c, d in zip(near, far)]
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(lists, pa.list_(pa.int32()))],
                                                 names=["rep", "v", "lists"])

    shape = f"rep {kind[id_col]}, v {kind[vector_col]}, lists array<int>"
    post = stored(entries.select("rep", "v").mapInArrow(assign, shape).select("rep", "v", F.explode("lists").alias("list")), "postings")
    blocks = post.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))        # at most MOST_LISTS rows
    post = post.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    # queries with equal vectors are searched once
    heads = asked.groupBy("v").agg(F.min("id").alias("rep"))
    visits = (heads.select("rep", "v").mapInArrow(visit, shape).select("rep", "v", F.explode("lists").alias("list"))
              .join(F.broadcast(blocks), "list")
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    pieces = 4 * partitions(spark)
    piece = F.pmod(F.xxhash64("list", "block"), F.lit(pieces)).cast("int")
    side = lambda df, asks: df.select(piece.alias("piece"), "list", "block", "rep", "v", F.lit(asks).alias("asks"))

    def score(t: pa.Table) -> pa.Table:
        asks = t.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        place = t.column("list").to_numpy().astype(np.int64) * (1 << 32) + t.column("block").to_numpy()
        x = unit(matrix(t.column("v")))
        rep = t.column("rep").to_numpy()
        order = np.argsort(place, kind="stable")
        cuts = np.r_[0, np.flatnonzero(np.diff(place[order])) + 1, len(order)]
        out = []
        for i, j in zip(cuts[:-1], cuts[1:]):
            at = order[i:j]
            ask, have = at[asks[at]], at[~asks[at]]
            if not len(ask) or not len(have):
                continue
            s = x[ask] @ x[have].T
            for a, row in zip(ask, s):
                # k + 1 entries are enough: the query's own entry may be one of them; ties all stay
                edge = np.partition(row, len(row) - 1 - k)[len(row) - 1 - k] if len(row) > k + 1 else -2.0
                best = np.flatnonzero(row >= edge)
                best = best[np.lexsort((rep[have[best]], -row[best]))][:k + 1]
                out.append((np.full(len(best), rep[a]), rep[have[best]], row[best]))
        if not out:
            return pa.table({"q": pa.array([], id_type), "rep": pa.array([], id_type), "score": pa.array([], pa.float64())})
        q, r, s = (np.concatenate(c) for c in zip(*out))
        # each entry once, then the k + 1 best of every query over all lists of this piece
        o = np.lexsort((-s, r, q))
        o = o[np.r_[True, (q[o][1:] != q[o][:-1]) | (r[o][1:] != r[o][:-1])]]
        o = o[np.lexsort((r[o], -s[o], q[o]))]
        new = np.flatnonzero(np.r_[True, q[o][1:] != q[o][:-1]])
        o = o[np.arange(len(o)) - np.repeat(new, np.diff(np.r_[new, len(o)])) <= k]
        q, r, s = q[o], r[o], s[o]
        return pa.table({"q": pa.array(q, id_type), "rep": pa.array(r, id_type), "score": pa.array(s, pa.float64())})

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(vectors.schema[id_col].dataType)
    found = (side(post, False).unionByName(side(visits, True)).groupBy("piece")
             .applyInArrow(score, f"q {kind[id_col]}, rep {kind[id_col]}, score double"))
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    best = (found.groupBy("q", "rep").agg(F.max("score").alias("score"))
            .withColumn("at", F.row_number().over(ranked)).where(F.col("at") <= k + 1).drop("at"))
    # entries become ids, searches become queries, and the query itself goes
    ids = best.join(entries.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("other"))
    ids = stored(ids.withColumn("at", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "other")))
                 .where(F.col("at") <= k + 1).drop("at"), "found")
    who = stored(asked.select("id", "v").join(stored(heads, "heads").withColumnRenamed("rep", "q"), "v").select("id", "q"), "who")
    final = who.join(ids, "q").where("id <> other")
    return (final.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "other")))
            .where(F.col("rank") <= k)
            .select(F.col("id").alias("query_id"), "rank", F.col("other").alias(id_col), "score"))
