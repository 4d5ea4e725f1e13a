"""Shared helpers of the training-data operators: tables, folders, vectorised words and hashes.

Everything here is page- or batch-local numpy, or a thin wrapper around Spark
readers and writers. Modules whose functions run in Python workers are pickled
by value (``ship``), so executors need no install of this package.
"""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20   # bytes of text handled by one round of numpy passes (one text may exceed it)
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # texts and pages can be long: few rows an Arrow batch, and a bound in bytes beside it
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # joins of texts with a list of ids: filter the texts by a Bloom filter before they are shuffled, at any size
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def ship(name: str) -> None:
    """Pickle the module ``name`` by value, so that Python workers need not import it."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)


def settle(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the operators expect."""
    for k, v in SETTINGS.items():
        try:
            spark.conf.set(k, v)
        except Exception:   # a setting this Spark release does not know
            if "maxBytesPerBatch" not in k:
                raise
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settle(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that driver and executors share: under spark.checkpoint.dir, else under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- numpy on texts

def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column and the n + 1 offsets of its texts (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(a)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = a.buffers()
    o = np.frombuffer(offs, np.int64)[a.offset:a.offset + n + 1]
    d = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None and o[-1] > o[0] else np.empty(0, np.uint8)
    return d, o - o[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """(first, last) row ranges whose texts hold at most ``limit`` bytes; a longer text stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, multiply) over an unsigned array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0xA24BAED4963EE407 | 1
_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for n positions."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.cumprod(p)
        b = mix(np.arange(1, 257, dtype=np.uint64))
        b[[9, 10, 11, 12, 13, 32]] = 0          # white space adds nothing to a word's sum
        _POWERS["byte"] = b
        low = np.arange(256)
        low[65:91] += 32
        _POWERS["lower"] = b[low]
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word ([^ \\t-\\r]+) of the texts, and the n + 1 word offsets of the texts.

    ``lower`` folds A-Z. Words of one text lie in order. The hash is a
    polynomial over the word's bytes: one table lookup, one multiplication and
    one segmented sum over all bytes, without a Python loop.
    """
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    up, down = _powers(n)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = space[:-1]
    starts = offsets[:-1]
    first[starts[starts < n]] = True
    first &= ~space
    at = np.flatnonzero(first)
    if len(at) == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    sums = np.add.reduceat(_POWERS["lower" if lower else "byte"][data] * up, at)
    return mix(sums * down[at]), np.searchsorted(at, offsets)


def word_marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``word_hashes`` with A-Z folded, but no structure of a word makes two of them meet.

    Each byte's value is multiplied by a pseudorandom number of its place in
    the word, not by a power of one base: sums of powers modulo 2**64 vanish
    for words built like the Thue-Morse sequence, whatever the base.
    """
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    _powers(1)                                   # the byte tables
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = space[:-1]
    starts = offsets[:-1]
    first[starts[starts < n]] = True
    first &= ~space
    at = np.flatnonzero(first)
    if len(at) == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    data = data[at[0]:]
    length = np.diff(np.append(at, n))
    place = np.arange(len(data), dtype=np.int64) - np.repeat(at - at[0], length)
    by_place = mix(np.arange(1, int(length.max()) + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    sums = np.add.reduceat(_POWERS["lower"][data] * by_place[place], at - at[0])
    return mix(sums), np.searchsorted(at, offsets)


def frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small driver-made table (quotas, cuts) without a Python worker."""
    return spark.createDataFrame(pa.Table.from_pylist(
        [dict(zip([c.split()[0] for c in schema.split(", ")], r)) for r in rows],
        schema=_arrow(spark, schema)))


def _arrow(spark: SparkSession, schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


def letters(col):
    """Whether a text holds any letter (null: false)."""
    return F.coalesce(F.col(col).rlike(r"\p{L}"), F.lit(False))
