"""Language mixtures of documents by expectation-maximisation (operator 1).

A document's n-grams are drawn from languages in unknown proportions. One pass
over the training rows counts hashed byte n-grams by language; a second pass
estimates each document's proportions by expectation-maximisation over the
n-gram likelihoods and picks the language set whose likelihood, less a penalty
for each further language, is largest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, letters, ship, utf8

ship(__name__)

CLASSES = 256           # groups of n-grams with like evidence
BINS = 1 << 16          # hashed n-grams; the model has BINS rows for each language
ORDER = 4               # bytes in an n-gram
PENALTY = 4.0           # cost of a further language, times log(n-grams)
ROUNDS = 8              # rounds of expectation-maximisation for each candidate set


def _letter_classes() -> np.ndarray:
    """Byte -> class: A-Z folded, other ASCII bytes that are no letters one class, UTF-8 bytes as they are."""
    t = np.arange(256, dtype=np.uint32)
    t[65:91] += 32
    t[:65] = 32
    t[91:97] = 32
    t[123:128] = 32
    return t


LETTERS = _letter_classes()


def grams(data: np.ndarray, offsets: np.ndarray, bins: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of the texts, and the n + 1 gram offsets.

    Grams that hold no letter are left out. Texts are joined by blanks, so a
    short text still has grams.
    """
    n = len(offsets) - 1
    size = np.diff(offsets)
    if len(data) == 0:
        return np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    pad = order - 1
    # one blank run of pad bytes before and after every text keeps grams within their text
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1) * pad, size)
    x = np.full(len(data) + (n + 1) * pad, 32, np.uint32)
    x[at] = LETTERS[data]
    h = np.zeros(len(x) - pad, np.uint32)
    for k in range(order):
        h = h * np.uint32(0x01000193) + x[k:len(x) - pad + k]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    blank = x == 32
    quiet = np.ones(len(h), bool)
    for k in range(order):
        quiet &= blank[k:len(x) - pad + k]
    # grams starting in the last blank run belong to no text; others to the text that follows or holds them
    ends = offsets[1:] + np.arange(1, n + 1) * pad
    keep = np.flatnonzero(~quiet)
    return (h[keep] & np.uint32(bins - 1)).astype(np.int64), np.r_[0, np.searchsorted(keep, ends)]


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", bins: int = BINS,
        order: int = ORDER) -> dict:
    """Model of the languages from every row with a language: n-gram classes and their likelihoods.

    Counting is a partial sum in each task, then a sum by (language, bin); what
    reaches the driver is bounded by bins x languages. Rows without language
    or text teach nothing; without any row the model has no language.
    """
    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(1).to_pylist()
            data, offsets = utf8(b.column(0))
            for i, j in chunks(offsets):
                g, at = grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], bins, order)
                code = {}
                for k in langs[i:j]:
                    code.setdefault(k, len(code))
                who = np.repeat(np.array([code[k] for k in langs[i:j]], np.int64), np.diff(at))
                sums = np.bincount(who * bins + g, minlength=len(code) * bins).reshape(len(code), bins)
                for k, c in code.items():
                    total[k] = total[k] + sums[c] if k in total else sums[c].astype(np.int64)
        for k, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at),
                                              pa.array(sums[at])], names=["lang", "bin", "n"])

    table = (rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
             .mapInArrow(count, "lang string, bin long, n long")
             .groupBy("lang", "bin").agg(F.sum("n").alias("n"))).toArrow()
    names = table.column(0).to_numpy(zero_copy_only=False)
    langs = sorted(set(names.tolist()))
    counts = np.zeros((bins, len(langs)))
    at = {k: i for i, k in enumerate(langs)}
    counts[table.column(1).to_numpy(), [at[k] for k in names]] = table.column(2).to_numpy()
    kinds, like = gram_classes(counts)
    return {"langs": langs, "kinds": kinds, "like": like, "bins": bins, "order": order}


def gram_classes(counts: np.ndarray, classes: int = CLASSES, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Group n-grams of like evidence: class of every bin, and the classes' likelihoods (classes x languages).

    A bin's evidence is its likelihood under each language, scaled to sum to
    one. Bins are grouped by weighted k-means on its logarithm; a class holds
    its bins' summed counts. A document's grams then become one histogram over
    classes, on which mixtures are estimated.
    """
    bins, langs = counts.shape
    if not langs:
        return np.zeros(bins, np.int64), np.ones((1, 0))
    like = (counts + 0.5) / (counts.sum(0) + 0.5 * bins)
    weight = counts.sum(1) + 1e-3
    point = np.log(like / like.sum(1, keepdims=True)).astype(np.float32)
    order = np.lexsort(point.T)
    centre = point[order[np.linspace(0, bins - 1, classes).astype(int)]]
    for _ in range(rounds):
        kind = (-2 * point @ centre.T + (centre ** 2).sum(1)).argmin(1)
        mass = np.bincount(kind, weight, classes)
        for k in range(langs):
            centre[:, k] = np.where(mass > 0, np.bincount(kind, weight * point[:, k], classes) / np.maximum(mass, 1e-12),
                                    centre[:, k])
    total = np.stack([np.bincount(kind, counts[:, k], classes) for k in range(langs)], 1) + 0.5
    total /= counts.sum(0) + 0.5 * classes
    return kind.astype(np.int64), total / total.max(1, keepdims=True)


def _mixture(like: np.ndarray, seen: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood after ``rounds`` of EM on class histograms; zeros stay zeros."""
    share, size = start, seen.sum(1, keepdims=True)
    for _ in range(rounds):
        share = share * ((seen / np.maximum(share @ like.T, 1e-300)) @ like) / size
    return share, (seen * np.log(np.maximum(share @ like.T, 1e-300))).sum(1)


def infer(like: np.ndarray, seen: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Best proportions (texts x languages) of texts given by class histograms; texts without grams get zeros.

    Candidate sets are the languages in order of their share in the full
    mixture: one, two, and so on. A larger set must raise the log-likelihood by
    more than ``penalty`` * log(grams) for each language it adds.
    """
    kinds = like.shape[1]
    out = np.zeros((len(seen), kinds))
    full = np.flatnonzero(seen.sum(1))
    if not kinds or not len(full):
        return out
    seen = seen[full].astype(np.float64)
    share, _ = _mixture(like, seen, np.full((len(full), kinds), 1 / kinds), rounds)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
    single = seen @ np.log(like)
    best = single.argmax(1)
    value = single[np.arange(len(full)), best]
    result = np.zeros((len(full), kinds))
    result[np.arange(len(full)), best] = 1
    cost = penalty * np.log(seen.sum(1) + 1)
    for k in range(2, kinds + 1):
        start = np.where(rank < k, share + 1e-9, 0)
        s, v = _mixture(like, seen, start / start.sum(1, keepdims=True), rounds)
        v -= cost * (k - 1)
        better = v > value
        value[better], result[better] = v[better], s[better]
    out[full] = result
    return out


def language_mixtures(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
                      penalty: float = PENALTY, rounds: int = ROUNDS) -> DataFrame:
    """(id, lang_pred, score, shares) for every row: the main language, its share, and all shares.

    Null texts, texts without a letter and any text under a model without
    languages give ``und``, score 0 and no shares. Ties go to the first
    language by name. Repeated rows give repeated results; other columns are
    not read. Texts are scored whole, in chunks of whole texts.
    """
    langs = model["langs"]
    # a class for each bin and a likelihood for each class and language: a fixed size
    sent = docs.sparkSession.sparkContext.broadcast((model["kinds"], model["like"]))

    def score(batches):
        kinds, like = sent.value
        classes = len(like)
        for b in batches:
            data, offsets = utf8(b.column(1))
            known = b.column(2).to_numpy(zero_copy_only=False)
            parts = []
            for i, j in chunks(offsets):
                g, at = grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], model["bins"], model["order"])
                owner = np.repeat(np.arange(j - i), np.diff(at))
                seen = np.bincount(owner * classes + kinds[g], minlength=(j - i) * classes).reshape(j - i, classes)
                parts.append(infer(like, seen, penalty, rounds))
            share = np.concatenate(parts) if parts else np.zeros((0, len(langs)))
            share[~known.astype(bool)] = 0
            best = share.argmax(1) if len(langs) else np.zeros(len(share), int)
            top = share.max(1) if len(langs) else np.zeros(len(share))
            top = np.clip(top, 0, 1)
            pred = [langs[k] if v > 0 else "und" for k, v in zip(best, top)]
            shares = [[(langs[k], float(v)) for k, v in enumerate(row) if v > 0] for row in share]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pred, pa.string()), pa.array(top, pa.float64()),
                 pa.array(shares, pa.map_(pa.string(), pa.float64()))], names=["id", "lang_pred", "score", "shares"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), letters(text_col).alias("known"))
            .mapInArrow(score, f"id {kind}, lang_pred string, score double, shares map<string,double>")
            .withColumnRenamed("id", id_col))


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row lies in the held-out fold: crc32 of its id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))
