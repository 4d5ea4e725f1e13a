"""Near duplicates of embeddings by sign hashing (operator 8).

Random hyperplanes give each vector a short sign code in several tables.
Vectors of one label and code are compared exactly, and the links found are
closed by distributed connected components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, ship, stored
from .components import connected_components

ship(__name__)

BLOCK = 1024             # rows of a bucket compared with each other in one piece of work
MISS = 1e-7              # chance that a pair at the threshold shares no code


def usable(col: str) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not zero."""
    good = F.forall(F.col(col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(F.col(col), lambda x: x != 0), F.lit(False))


def tables_for(bits: int, threshold: float, miss: float = MISS) -> int:
    """Tables of ``bits`` signs that let at most ``miss`` of the pairs at the threshold pass unseen."""
    hit = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log1p(-hit))) if hit < 1 else 1


def matrix(column) -> np.ndarray:
    """An Arrow list column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component is taken out first, so that no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def forest(hit: np.ndarray, left: np.ndarray, right: np.ndarray, n: int):
    """(first, others) for each connected set of the rows 0..n that ``hit`` (left x right) links."""
    place_left, place_right = np.full(n, -1), np.full(n, -1)
    place_left[left], place_right[right] = np.arange(len(left)), np.arange(len(right))
    seen = np.zeros(n, bool)
    for first in np.r_[left[hit.any(1)], right[hit.any(0)]]:
        if seen[first]:
            continue
        seen[first] = True
        front, found = np.array([first]), []
        while len(front):
            near = np.zeros(n, bool)
            i = place_left[front]
            near[right[hit[i[i >= 0]].any(0)]] = True
            i = place_right[front]
            near[left[hit[:, i[i >= 0]].any(1)]] = True
            front = np.flatnonzero(near & ~seen)
            seen[front] = True
            found.append(front)
        yield first, np.concatenate(found)


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.98, bits: int | None = None, seed: int = 11) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    Rows of equal, non-null label and equal dimension are linked when their
    cosine in double precision reaches ``threshold``. Null, zero and
    non-finite vectors link with nothing. Equal vectors of a label are one
    class from the start, so a vector that a third of all rows share is one
    row of the work; they count as links of each other. Repeated ids stand for
    one node. An empty table gives no rows.

    ``bits`` grows with the logarithm of the largest label (None), the number
    of tables with it, so that a pair at the threshold is missed with a chance
    below MISS. A bucket of more than BLOCK rows is compared block by block in
    separate pieces; of the pairs found only each row's number of partners and
    a spanning forest leave a piece of work, never the pairs.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    part = stored(rows.where(F.col("label").isNotNull() & F.col("id").isNotNull() & usable("v"))
                  .groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    top = part.groupBy("label", F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n")).first()
    if bits is None:
        bits = min(24, max(8, math.ceil(math.log2(max(1, top["n"] if top else 1) / 32))))
    count = tables_for(bits, threshold)

    def code(batches):
        for b in batches:
            for dim in np.unique(np.array([len(x) for x in b.column(2)], np.int64)):
                at = pa.array(np.flatnonzero(np.array([len(x) for x in b.column(2)]) == dim))
                sub = b.take(at)
                planes = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), count * bits))
                x = unit(matrix(sub.column(2)))
                signs = (x @ planes > 0).reshape(len(x), count, bits)
                codes = (signs * (1 << np.arange(bits))).sum(2).astype(np.int32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), count).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*sub.columns, flat], names=["label", "rep", "v", "copies", "codes"])

    kind = dict(rows.dtypes)
    coded = stored(part.select("label", "rep", "v", "copies")
                   .mapInArrow(code, f"label {kind['label']}, rep {kind['id']}, v {kind['v']}, copies long, codes array<int>"),
                   "codes")
    bucket = ["label", "dim", "t", "code"]
    keyed = coded.select("*", F.size("v").alias("dim"), F.posexplode("codes").alias("t", "code"))
    # one row a bucket; buckets of one row have no partner
    sizes = keyed.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    sized = (keyed.join(stored(sizes, "buckets"), bucket)
             .withColumn("blocks", F.ceil(F.col("n") / BLOCK))
             .withColumn("own", F.pmod(F.xxhash64("rep", "t"), F.col("blocks"))))
    spread = sized.select(*bucket, "rep", "v", "copies", "codes", "own",
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    work = spread.withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other"))
    pieces = 4 * partitions(spark)
    work = work.withColumn("piece", F.pmod(F.xxhash64(*bucket, "one", "two"), F.lit(pieces)).cast("int"))

    def compare(piece: pa.Table) -> pa.Table:
        ids = piece.column("rep").to_pylist()
        keys = [piece.column(c).to_pylist() for c in ("label", "dim", "t", "code", "one", "two")]
        groups: dict = {}
        for i, key in enumerate(zip(*keys)):
            groups.setdefault(key, []).append(i)
        copies, own = piece.column("copies").to_numpy(), piece.column("own").to_numpy()
        codes = np.stack(piece.column("codes").to_pylist())
        lists = piece.column("v").combine_chunks()
        out_id, out_links, edge_a, edge_b = [], [], [], []
        for (_, _, t, _, one, two), at in groups.items():
            if len(at) < 2:
                continue
            at = np.array(at)
            x = unit(matrix(lists.take(pa.array(at))))
            left = np.flatnonzero(own[at] == one)
            right = left if one == two else np.flatnonzero(own[at] == two)
            hit = x[left] @ x[right].T >= threshold
            if one == two:
                np.fill_diagonal(hit, False)
            if not hit.any():
                continue
            # a pair counts in the first table that brings it together
            c = codes[at]
            for k in range(t):
                hit &= c[left, k][:, None] != c[right, k][None, :]
            n_left, n_right = hit @ copies[at[right]], copies[at[left]] @ hit
            links = np.zeros(len(at), np.int64)
            links[left] += n_left
            if one != two:
                links[right] += n_right
            for i in np.flatnonzero(links):
                out_id.append(ids[at[i]])
                out_links.append(int(links[i]))
            for first, others in forest(hit, left, right, len(at)):
                edge_a += [ids[at[first]]] * len(others)
                edge_b += [ids[i] for i in at[others]]
        n, m = len(out_id), len(edge_a)
        return pa.table({"id": pa.array(out_id + edge_a, id_type), "links": pa.array(out_links + [None] * m, pa.int64()),
                         "other": pa.array([None] * n + edge_b, id_type)})

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(rows.schema["id"].dataType)
    found = stored(work.groupBy("piece").applyInArrow(compare, f"id {kind['id']}, links long, other {kind['id']}"), "links")
    partners = found.where("links is not null").groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    classes = (part.select("label", "v", "rep", "copies")
               .join(stored(partners, "partners"), F.col("rep") == F.col("id"), "left").drop("id")
               .join(stored(groups, "groups"), F.col("rep") == F.col("node"), "left")
               .select("label", "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                       F.coalesce("component", "rep").alias("component")))
    return (rows.join(stored(classes, "classes"), ["label", "v"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.col(id_col) == F.col("component_id")))
