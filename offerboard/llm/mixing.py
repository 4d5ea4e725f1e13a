"""Mixing sources to target weights with fixed-length blocks (operator 7).

Every source's documents, laid end to end, are cut into blocks of ``block``
words. Each output shard draws its sources' slot counts from a multinomial over
what the sources still have to give, so that all shards together meet the
quotas exactly. The j-th slot of a source takes the block that a keyed
pseudorandom permutation of the source's block indices gives for j; after all
blocks a new permutation starts. Slots and documents meet in a join by block
index.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from .common import frame, mix, partitions, ship, stored

ship(__name__)

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 32                 # words in a block
SHARD_SLOTS = 1 << 16      # slots of an output shard
STRETCH_DOCS = 4096        # documents of a source whose running sum is one task's work


def targets(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words each source gives: shares of ``share`` * total by weight, none above ``most`` * its size.

    A source that would pass its bound stops there; what is left is shared
    again by weight among the others until none is above.
    """
    goal, left = [0.0] * len(sizes), share * sum(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    while free and left > 0:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in free:
                goal[i] = unit * weights[i]
            break
        for i in full:
            goal[i] = most * sizes[i]
            left -= goal[i]
        free = [i for i in free if i not in full]
    return goal


def draw(quotas: np.ndarray, shard_slots: int, seed: int) -> np.ndarray:
    """Slot counts (shards x sources): multinomial draws over the remaining quotas, which all shards together meet."""
    left = quotas.astype(np.int64).copy()
    shards = max(1, -(-int(left.sum()) // shard_slots))
    out = np.zeros((shards, len(left)), np.int64)
    for s in range(shards):
        rng = np.random.default_rng([seed, s])
        want = min(shard_slots, int(left.sum()))
        while want:
            got = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[s] += got
            left -= got
            want -= int(got.sum())
    return out


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutation of range(size) at each index: four Feistel rounds, walked until inside the range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        h, m, k = half[todo], low[todo], key[todo]
        a, b = out[todo] >> h, out[todo] & m
        for r in range(4):
            a, b = b, a ^ (mix(b + k + np.uint64(r * 0x5851F42D)) & m)
        out[todo] = a << h | b
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


class Mix(NamedTuple):
    """documents: what is taken of each row; slots: the blocks of the mix; cuts: the words taken of each row and epoch."""

    documents: DataFrame
    slots: DataFrame
    cuts: DataFrame


def whole_mark(docs: DataFrame):
    """A hash of a row's columns; with the mark of id and text it tells rows apart that differ anywhere."""
    nested = [f.name for f in docs.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    values = [F.to_json(F.struct(F.col(c).alias("v"))) if c in nested else F.col(c) for c in docs.columns]
    return F.xxhash64(F.lit("whole row"), *[F.col(c).isNull() for c in docs.columns], *values)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0,
                block: int = BLOCK, seed: int = 7) -> Mix:
    """The mix of all rows, as documents, slots and cuts.

    documents: row, id, size (words of the text, null: 0), source_size, target
    and taken (words the mix takes, repeats counted) for every row. slots:
    shard, source, epoch, block (index within the source). cuts: row, id, mark,
    size, epoch, first and last (word ranges of the row's text, last exclusive)
    for every row, epoch and block that meet.

    ``weights`` repeat over the sources in code point order, null last; the
    mix holds ``share`` times all words, a source at most ``most`` times its
    own. Sources without words have target 0. Empty tables give empty results;
    repeated rows count each for itself; other columns are not read. Only one
    line for each source, and shard counts, reach the driver.

    Running sums do not need a source in one task: documents fall by hash into
    stretches of a source (about STRETCH_DOCS documents each); sums are taken
    within a stretch, and over the stretches' totals.
    """
    spark = docs.sparkSession
    measured = stored(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("mark"), whole_mark(docs).alias("full")), "mix-sizes")
    per_source = measured.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).collect()
    per_source = sorted(per_source, key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [r["size"] for r in per_source]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    blocks = [-(-s // block) for s in sizes]
    # slots whose words come nearest to the target; never more than the bound allows for each block
    quota = np.array([min(round(g / s * b), int(most * b)) if s else 0 for g, s, b in zip(goal, sizes, blocks)], np.int64)
    counts = draw(quota, SHARD_SLOTS, seed) if quota.sum() else np.zeros((0, len(quota)), np.int64)
    from_slot = np.cumsum(counts, 0) - counts
    sources = frame(spark, [(r.source, i, r["size"], g, b, max(1, -(-r.docs // STRETCH_DOCS)))
                            for i, (r, g, b) in enumerate(zip(per_source, goal, blocks))],
                    "source string, number long, source_size long, target double, blocks long, stretches long")
    shares = frame(spark, [(s, i, blocks[i], int(from_slot[s, i]) + at, min(4096, int(counts[s, i]) - at))
                           for s in range(len(counts)) for i in np.flatnonzero(counts[s]).tolist()
                           for at in range(0, int(counts[s, i]), 4096)],
                   "shard long, number long, blocks long, first long, n long")

    def place(batches):
        for pdf in batches:
            size = pdf["blocks"].to_numpy()
            slot = pdf["slot"].to_numpy()
            epoch = slot // np.maximum(size, 1)
            key = mix(pdf["number"].to_numpy().astype(np.uint64) * np.uint64(1 << 20)
                      + epoch.astype(np.uint64) + np.uint64(seed * (1 << 40)))
            yield pd.DataFrame({"shard": pdf["shard"], "number": pdf["number"], "epoch": epoch,
                                "block": permuted(slot % np.maximum(size, 1), size, key)})

    slots = (shares.repartition(partitions(spark), "shard", "number", "first")
             .select("shard", "number", "blocks", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot"))
             .mapInPandas(place, "shard long, number long, epoch long, block long"))
    slots = stored(slots, "mix-slots")
    uses = slots.groupBy("number", "block").agg(F.count("*").alias("uses"))

    # where each document lies in its source
    known = measured.join(F.broadcast(sources) if len(per_source) <= 10_000 else sources,
                          measured["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    known = known.withColumn("stretch", F.pmod(F.col("mark"), F.col("stretches")))
    totals = known.groupBy("number", "stretch").agg(F.sum("size").alias("words"))
    before = totals.select("number", "stretch", (F.sum("words").over(
        Window.partitionBy("number").orderBy("stretch")) - F.col("words")).alias("base"))
    inside = Window.partitionBy("number", "stretch").orderBy("id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored(known.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
                    .join(before, ["number", "stretch"])
                    .select("id", "mark", "full", "number", "size", "source_size", "target", (F.col("base") + F.col("ahead")).alias("start"))
                    .withColumn("row", F.monotonically_increasing_id()), "mix-places")
    end = F.col("start") + F.col("size")
    parts = (placed.where("size > 0")
             .select("row", "id", "mark", "full", "size", "number", "start", end.alias("end"),
                     F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).alias("block"))
             .select("row", "id", "mark", "full", "size", "number", "block",
                     (F.greatest(F.col("start"), F.col("block") * block) - F.col("start")).alias("first"),
                     (F.least(F.col("end"), (F.col("block") + 1) * block) - F.col("start")).alias("last")))
    taken = (parts.join(uses, ["number", "block"]).groupBy("row")
             .agg(F.sum((F.col("last") - F.col("first")) * F.col("uses")).alias("taken")))
    cuts = parts.join(slots.select("number", "block", "epoch"), ["number", "block"]).select(
        "row", "id", "mark", "full", "size", "epoch", "first", "last")
    result = (placed.join(taken, "row", "left")
              .select("row", F.col("id").alias(id_col), "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
    named = F.broadcast(sources.select("number", "source")) if len(per_source) <= 10_000 else sources.select("number", "source")
    return Mix(result, slots.join(named, "number").select("shard", "source", "epoch", "block"), cuts)


def mixed_documents(docs: DataFrame, mix_: Mix, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: one row for each epoch that takes words of a row.

    A row taken whole keeps its text; otherwise its taken stretches follow
    each other, one a line, their words joined by blanks. ``length_col`` is
    set to the new text's characters. Rows without an id are mixed like all
    others. Rows that are equal in every column are exchangeable: one of them
    meets the takes of all, so no text is numbered and each one is shuffled
    once; copies go before the shuffle, as far as they share a task.
    """
    takes = (mix_.cuts.groupBy("row", "mark", "full", "size", "epoch")
             .agg(F.sum(F.col("last") - F.col("first")).alias("words"),
                  F.array_sort(F.collect_list(F.struct("first", "last"))).alias("ranges"))      # blocks of one text
             .select("mark", "full", F.struct((F.col("words") == F.col("size")).alias("all"), "ranges").alias("take")))
    own = docs.columns
    left = docs.where(F.col(text_col).rlike(WORD)).select(
        F.struct(*own).alias("doc"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("mark"), whole_mark(docs).alias("full"))
    first = F.row_number().over(Window.partitionBy("mark", "full").orderBy("mark"))
    rows = left.withColumn("nth", first).where("nth = 1").join(takes, ["mark", "full"]).select("doc", "take")
    words = F.filter(F.split(F.col("doc")[text_col], r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def stretch(ranges, all_words):
        joined = F.aggregate(ranges, F.array().cast("array<struct<first:bigint,last:bigint>>"), lambda a, r: F.when(
            (F.size(a) > 0) & (F.get(a, F.size(a) - 1)["last"] == r["first"]),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1),
                     F.array(F.struct(F.get(a, F.size(a) - 1)["first"].alias("first"), r["last"].alias("last"))))
        ).otherwise(F.concat(a, F.array(r))))
        return F.array_join(F.transform(joined, lambda r: F.array_join(
            F.slice(all_words, (r["first"] + 1).cast("int"), (r["last"] - r["first"]).cast("int")), " ")), "\n")

    text = F.when(F.col("take.all"), F.col("doc")[text_col]).otherwise(
        F.get(F.transform(F.array(words), lambda w: stretch(F.col("take.ranges"), w)), F.lit(0)))
    rows = rows.select("doc", text.alias("mixed"))
    return rows.select(*[F.col("mixed").alias(c) if c == text_col else
                         F.length("mixed").cast(docs.schema[c].dataType).alias(c) if c == length_col else
                         F.col("doc")[c].alias(c) for c in own])
