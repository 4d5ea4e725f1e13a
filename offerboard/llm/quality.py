"""Quality by importance resampling (operator 5).

Two generative models of hashed n-grams are counted: one of the target (texts
labelled good), one of all raw text. A document's log importance weight is the
ratio of its likelihoods, taken at a fixed length. Documents are sampled
without replacement by Gumbel top-k: weight plus Gumbel noise, the k largest
stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix, ship, stored, utf8, word_hashes

ship(__name__)

BINS = 1 << 16           # hashed n-grams of each model
ORDER = 4                # bytes of a byte n-gram
LENGTH = 64.0            # n-grams at which every text's likelihood ratio is taken
LABELLED = 20_000        # labelled rows used at most: those of the smallest hash


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams of texts as (bins, n + 1 offsets): words with word pairs, and byte n-grams.

    A word followed by itself is one pair, whatever the word.
    """
    words, at = word_hashes(data, offsets, lower=False)
    bins = np.uint64(BINS - 1)
    both = np.empty(2 * len(words), np.int64)
    if len(words):
        follow = np.r_[words[1:], np.uint64(0)]
        size = np.diff(at)
        follow[at[1:][size > 0] - 1] = 0
        pair = mix(words * np.uint64(3) + mix(follow))
        pair[words == follow] = 1
        both[0::2] = mix(words) & bins
        both[1::2] = pair & bins
    if len(data) >= ORDER:
        x = data.astype(np.uint32)
        h = np.zeros(len(x) - ORDER + 1, np.uint32)
        for k in range(ORDER):
            h = h * np.uint32(0x01000193) + x[k:len(h) + k]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        inside = np.zeros(len(x), bool)
        inside[:len(h)] = True
        for k in range(1, ORDER):                      # grams that would run into the next text
            ends = offsets[1:] - k
            inside[ends[(ends >= offsets[:-1])]] = False
        keep = np.flatnonzero(inside[:len(h)])
        return [(both, at * 2), ((h[keep] & np.uint32(BINS - 1)).astype(np.int64), np.searchsorted(keep, offsets))]
    return [(both, at * 2), (np.empty(0, np.int64), np.zeros(len(offsets), np.int64))]


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, most: int = LABELLED) -> list[tuple]:
    """(id, good, for fitting) of at most ``most`` labelled rows: those of the smallest hash of their id.

    Ids with contradicting labels, and null ids or labels, are left out. Half
    of the sample fits the target model, half sets the size of the result.
    """
    rows = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("high"))
            .where("low = high").select("id", (F.col("low") > 0).alias("good"), F.xxhash64("id").alias("mark"))
            .orderBy("mark", "id").limit(most).collect())
    return [(r["id"], bool(r["good"]), r["mark"] % 2 == 0) for r in rows]


def fit(docs: DataFrame, sample: list[tuple], id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Log ratios (2 models x BINS) of target to raw text; raw counts cover every document.

    One pass: each task counts all its texts, and apart those of the target.
    What reaches the driver is bounded by the bins.
    """
    good = docs.sparkSession.sparkContext.broadcast({k for k, is_good, fits in sample if is_good and fits})

    def count(batches):
        target = good.value
        total = np.zeros((4, BINS), np.int64)
        for b in batches:
            data, offsets = utf8(b.column(1))
            is_target = np.array([k in target for k in b.column(0).to_pylist()], bool)
            for i, j in chunks(offsets):
                for m, (g, at) in enumerate(features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])):
                    total[2 * m] += np.bincount(g, minlength=BINS)
                    if is_target[i:j].any():
                        total[2 * m + 1] += np.bincount(g[np.repeat(is_target[i:j], np.diff(at))], minlength=BINS)
        kind, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(at), pa.array(total[kind, at])], names=["kind", "bin", "n"])

    t = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
         .mapInArrow(count, "kind long, bin long, n long").groupBy("kind", "bin").agg(F.sum("n").alias("n"))).toArrow()
    total = np.zeros((4, BINS))
    total[t.column(0).to_numpy(), t.column(1).to_numpy()] = t.column(2).to_numpy()
    if not total[1].sum():
        return np.zeros((2, BINS))
    logs = np.log((total + 1) / (total.sum(1, keepdims=True) + BINS))
    return logs[1::2] - logs[0::2]


def weigh(docs: DataFrame, ratios: np.ndarray, text_col: str = "text", out_col: str = "log_weight") -> DataFrame:
    """All columns of ``docs`` and the log importance weight of each text (null without any word).

    Both models' mean log ratio over a text's n-grams, at LENGTH n-grams, so
    that long texts weigh no more than short ones.
    """
    if out_col in docs.columns:
        raise ValueError(f"{out_col} is already a column")
    sent = docs.sparkSession.sparkContext.broadcast(ratios)       # 2 x BINS numbers
    at_text = docs.columns.index(text_col)

    def score(batches):
        ratio = sent.value
        for b in batches:
            data, offsets = utf8(b.column(at_text))
            out = np.zeros(b.num_rows)
            words = np.zeros(b.num_rows, np.int64)
            for i, j in chunks(offsets):
                for m, (g, at) in enumerate(features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])):
                    n = np.diff(at)
                    out[i:j] += np.bincount(np.repeat(np.arange(j - i), n), ratio[m][g], j - i) / np.maximum(n, 1)
                    if m == 0:
                        words[i:j] = n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out * LENGTH, mask=words == 0)],
                                             names=[*b.schema.names, out_col])

    from pyspark.sql.types import DoubleType, StructType
    schema = StructType(list(docs.schema.fields)).add(out_col, DoubleType())
    return docs.mapInArrow(score, schema)


def gumbel_key(id_col: Column, weight: Column, seed: int) -> Column:
    """Weight plus Gumbel noise that depends on id and seed alone."""
    u = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11) + 0.5) / float(1 << 53)
    return weight - F.log(-F.log(u))


def kth_largest(df: DataFrame, col: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value of a column, by counting in ever narrower ranges; never sorts or collects rows."""
    low, high = df.agg(F.min(col), F.max(col)).first()
    if low is None or k <= 0:
        return float("inf")
    while True:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            return low
        place = F.least(F.floor((F.col(col) - low) / width), F.lit(bins - 1))
        counts = (df.where(F.col(col).between(low, high)).groupBy(place.alias("place"))
                  .agg(F.count("*").alias("n"), F.min(col).alias("low"), F.max(col).alias("high")).collect())
        for r in sorted(counts, key=lambda r: -r["place"]):
            if k <= r["n"]:
                break
            k -= r["n"]
        else:
            return low
        if r["low"] == r["high"] or k == r["n"]:
            return r["low"]
        if (r["low"], r["high"]) == (low, high):
            low = (low + high) / 2          # one range holds all: numbers too close for the width
        else:
            low, high = r["low"], r["high"]


def cut(scored: list[tuple[float, bool]], clean: float = 4.0) -> float:
    """The weight below which labelled rows count as bad: fewest errors, a lost good row counting ``clean`` bad ones."""
    good = np.sort([w for w, g in scored if g])
    bad = np.sort([w for w, g in scored if not g])
    if not len(good) or not len(bad):
        return float("-inf")
    edges = np.unique(np.r_[good, bad])
    cuts = np.r_[edges[0] - 1, (edges[1:] + edges[:-1]) / 2]
    lost = np.searchsorted(good, cuts, "left") / len(good) * clean
    passed = (len(bad) - np.searchsorted(bad, cuts, "left")) / len(bad)
    return float(cuts[(lost + passed).argmin()])


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", k: int | None = None, seed: int = 5) -> tuple[DataFrame, float, np.ndarray]:
    """((id, log_weight, key), threshold, ratios): a document is kept when its key reaches the threshold.

    ``k`` documents of largest key are kept, with ties at the threshold. If
    ``k`` is None it is the number of documents whose weight passes the cut
    that separates the labelled rows not used for fitting best. Texts without a word (null, empty, white space) have no
    weight, a null key, and are never kept. Without good labels all weights
    are 0; without bad ones every document with a word is kept. Repeated rows
    have the same key. Empty tables give empty results.
    """
    sample = labelled_sample(labels, id_col, label_col)
    ratios = fit(docs, sample, id_col, text_col)
    rows = weigh(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ratios, "text")
    scored = stored(rows.select("id", "log_weight", gumbel_key(F.col("id"), F.col("log_weight"), seed).alias("key")), "weights")
    if k is None:
        spark = docs.sparkSession
        rest = {i: good for i, good, fits in sample if not fits}
        if rest:
            held = spark.createDataFrame(pa.table({"id": pa.array(list(rest)), "good": pa.array(list(rest.values()))}))
            pairs = scored.where("key is not null").join(F.broadcast(held), "id").groupBy("id", "good").agg(
                F.max("log_weight").alias("w")).collect()      # at most LABELLED rows
            edge = cut([(r["w"], r["good"]) for r in pairs])
        else:
            edge = float("-inf")
        k = scored.where(F.col("log_weight") >= edge).count()
    return scored, kth_largest(scored.where("key is not null"), "key", k), ratios


def selected(docs: DataFrame, ratios: np.ndarray, threshold: float, id_col: str = "doc_id", text_col: str = "text",
             seed: int = 5) -> DataFrame:
    """The rows of ``docs`` that the sample keeps, with their own columns; no shuffle, no join."""
    name = "log_weight"
    while name in docs.columns:
        name += "_"
    key = gumbel_key(F.col(id_col), F.col(name), seed)
    return weigh(docs, ratios, text_col, name).where(F.coalesce(key >= threshold, F.lit(False))).select(*docs.columns)
