"""Whitening of embeddings by shifted CholeskyQR (operator 11).

The distinct vectors, on an integer grid, are the fit list. Each distributed
pass adds up the Gram matrix of the centred rows, orthogonalised by triangular
solves with the R factors known so far; its Cholesky factor is the next R. The
product of the factors has the singular values and right vectors of the
centred rows, so its SVD gives the components.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

ship(__name__)

GRID, OFFSET = 64, 1_000_000
ROWS = 4096               # rows of a matrix held at once
RIDGE = 1e-10             # virtual rows RIDGE * |X| * I keep every Gram matrix positive definite
RANK = 1e-8               # singular values below this share of the largest count as zero
PASSES = 12               # Gram passes at most; three are usual
WHOLE = 2.0 ** 63


def on_grid(col: str):
    """floor(GRID * c) + OFFSET of every entry as long; null if the vector takes no part.

    A vector takes no part if it is null or holds null, non-finite or such
    large entries that the result is no long.
    """
    fits = F.forall(F.col(col), lambda c: c.isNotNull() & ~F.isnan(c)
                    & (F.abs(c.cast("double")) * GRID < WHOLE - 2 * OFFSET))
    return F.when(fits, F.transform(col, lambda c: F.floor(c.cast("double") * GRID) + F.lit(OFFSET).cast("long")))


def lists(column) -> np.ndarray:
    """An Arrow column of lists of one length as a matrix of 64-bit integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


@dataclass
class Fit:
    """Count and sums of the fit list, its R factors, and the components found."""
    n: int
    sums: list[int]
    small: bool                     # n * x and the squared deviations fit in 64 bits
    factors: list[np.ndarray] = field(default_factory=list)
    axes: np.ndarray | None = None      # a column a component
    values: np.ndarray | None = None    # their eigenvalues
    explained: np.ndarray | None = None

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: 64-bit integers, or Python's if those do not hold them."""
        kind = np.int64 if self.small else object
        return x.astype(kind) * (self.n if self.small else int(self.n)) - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(np.float64) / self.n

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        """Centred rows through the triangular solves known so far."""
        q = self.centred(x)
        for r in self.factors:
            q = np.linalg.solve(r.T, q.T).T
        return q

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)


def _gram(fit_list: DataFrame, width: int, rows_of) -> np.ndarray:
    """Sum of the rows' outer products: one partial matrix a task, added up entry by entry."""
    def partial(batches):
        total = np.zeros((width, width))
        for b in batches:
            x = lists(b.column(0))
            for i in range(0, len(x), ROWS):
                q = rows_of(x[i:i + ROWS])
                total += q.T @ q
        at = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(total[at])],
                                         names=["i", "j", "g"])

    cells = (fit_list.select("x").mapInArrow(partial, "i int, j int, g double")
             .groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow())
    out = np.zeros((width, width))
    i, j, g = (cells.column(c).to_numpy() for c in ("i", "j", "g"))
    out[i, j] = out[j, i] = g
    return out


def _sums(fit_list: DataFrame) -> tuple[int, list[int], int]:
    """Rows, sums of every position and the largest entry, exactly."""
    def partial(batches):
        n, total, top = 0, None, 0
        for b in batches:
            x = lists(b.column(0))
            if not len(x):
                continue
            n, top = n + len(x), max(top, int(np.abs(x).max()))
            # halves of 32 bits, so that no sum of a batch overflows
            part = [int(h) * (1 << 32) + int(l) for h, l in zip((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0))]
            total = part if total is None else [a + c for a, c in zip(total, part)]
        if total is not None:
            size = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array(total, pa.decimal128(38, 0)),
                 pa.array([n] * size, pa.int64()), pa.array([top] * size, pa.int64())], names=["i", "s", "n", "top"])

    cells = (fit_list.select("x").mapInArrow(partial, "i int, s decimal(38, 0), n long, top long")
             .groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("top").alias("top")).orderBy("i").collect())
    return cells[0].n, [int(c.s) for c in cells], cells[0].top


def fit_whitening(fit_list: DataFrame, components: int = 16) -> Fit:
    """Fit on the distinct vectors of column x (all of one length, at least one row).

    Virtual rows of a tiny multiple of the identity stand under the centred
    ones, so that the factorisation never fails on dependent or constant
    dimensions; their share is taken off the squared singular values. Driver
    and tasks hold matrices of dimension x dimension, nothing that grows with
    the rows.
    """
    n, sums, top = _sums(fit_list)
    width = len(sums)
    fit = Fit(n, sums, (2.0 * top * n) ** 2 * width < WHOLE)
    if not fit.small:      # the bound by the largest entry is loose: try the spread itself
        low, high = fit_list.select(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
        fit.small = (float(high - low) * n) ** 2 * width < WHOLE and 2.0 * top * n < WHOLE
    ridge = None
    for turn in range(PASSES):
        gram = _gram(fit_list, width, fit.orthogonal)
        if ridge is None:
            trace = float(np.trace(gram))
            if trace == 0:
                break
            ridge = RIDGE * np.sqrt(trace) * np.eye(width)
        gram += ridge.T @ ridge
        if turn and np.abs(gram - np.eye(width)).max() < 1e-9:
            fit.factors.append(np.linalg.cholesky(gram).T)
            break
        size, unit = np.linalg.norm(gram, 2), np.finfo(float).eps / 2
        # the first pass is shifted; later ones are only if rounding makes the matrix indefinite
        shift = 11 * (n * width + width * (width + 1)) * unit * size if turn == 0 else 0.0
        while True:
            try:
                r = np.linalg.cholesky(gram + shift * np.eye(width)).T
                break
            except np.linalg.LinAlgError:
                shift = max(10 * shift, width * unit * size)
        fit.factors.append(r)
        ridge = np.linalg.solve(r.T, ridge.T).T
    if not fit.factors:
        fit.axes, fit.values, fit.explained = np.zeros((width, 0)), np.zeros(0), np.zeros(0)
        return fit
    whole = np.eye(width)
    for r in fit.factors:
        whole = r @ whole
    _, sigma, axes = np.linalg.svd(whole)
    square = sigma ** 2 - (RIDGE ** 2) * trace
    keep = min(components, int((square > (RANK * sigma[0]) ** 2).sum()))
    axes = axes[:keep].T
    axes = axes * np.where(axes[np.abs(axes).argmax(0), range(keep)] < 0, -1.0, 1.0)
    fit.axes, fit.values, fit.explained = axes, square[:keep] / n, square[:keep] / trace
    return fit


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every vector that takes part.

    Vectors that are null or hold null, non-finite or too large entries give
    no rows, nor do empty vectors. If lengths differ, the length that most
    rows have counts (the longer one of equal ones), other rows give none.
    Repeated vectors are one row of the fit list and each get their own
    result; null and repeated ids stay as they are. Components whose
    eigenvalue is zero within rounding are left out: they cannot be whitened.
    A deviation that no long holds is null. Each component's largest entry by
    size is positive. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).alias("id"), on_grid(vector_col).alias("x")).where(F.size("x") > 0)
    schema = ("id " + vectors.schema[id_col].dataType.simpleString()
              + ", component int, n long, deviation long, whitened double, explained double, identity_error double")
    distinct = stored(rows.groupBy("x").agg(F.count("*").alias("copies")), "fit")
    most = (distinct.groupBy(F.size("x").alias("width")).agg(F.sum("copies").alias("c"))
            .orderBy(F.desc("c"), F.desc("width")).first())
    if most is None:
        return rows.where("false").select(F.col("id").alias(id_col), *[
            F.lit(None).cast(t).alias(n) for n, t in (c.split(" ") for c in schema.split(", ")[1:])])
    fit_list = distinct.where(F.size("x") == most.width).select("x")
    fit = fit_whitening(fit_list, components)
    keep = fit.axes.shape[1]
    error = float(np.abs(_gram(fit_list, keep, fit.whitened) / fit.n - np.eye(keep)).max()) if keep else 0.0
    most_long = 2 ** 63 - 1

    def project(batches):
        for b in batches:
            x = lists(b.column(1))
            for i in range(0, len(x), ROWS):
                part = x[i:i + ROWS]
                m = len(part)
                d = fit.spread(part)
                deviation = (d * d).sum(1)
                if not fit.small:
                    deviation = [v if v <= most_long else None for v in deviation.tolist()]
                deviation = pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), keep)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, m).take(pa.array(np.repeat(np.arange(m), keep))),
                     pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), m)), pa.array(np.full(m * keep, fit.n)),
                     deviation, pa.array(fit.whitened(part).ravel()), pa.array(np.tile(fit.explained, m)),
                     pa.array(np.full(m * keep, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("x") == most.width).mapInArrow(project, schema).withColumnRenamed("id", id_col)
