"""Source divergence audit from single-pass in-memory term indexing (operator 12).

Each task indexes its documents block by block: postings of (lang, term) with
each source's occurrences and documents are held in memory until the block is
full, then spilled as a term-sorted run. Runs go to hash shards of their
terms, where a heap merges them, at most FAN_IN at a time, into frequencies.
What a pair of sources differs by is summed from each source's own counts
against terms the other one lacks, and the terms that both hold come in as
streamed corrections of that sum.
"""

from __future__ import annotations

from collections import defaultdict
from heapq import merge

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import chunks, partitions, ship, stored, utf8

ship(__name__)

BLOCK = 600_000            # postings that a block holds before it is spilled (one document may exceed it)
PIECE = 4 << 20            # bytes of texts that are cut into terms at once (one document may exceed it)
SHARD_POSTINGS = 1_000_000 # spilled postings that a shard merges, on average
BATCH = 100_000            # postings that leave a shard in one batch (one term may exceed it)
FAN_IN = 256               # runs that meet in one merge; more of them merge in several passes
PAIRS = 1 << 21            # corrections of pairs held at once
ONE = 1_000_000_000
RUN = "key binary, run long, sources array<string>, counts array<long>, docs array<long>"
FREQUENCY = "lang string, term string, source string, count long, lang_count long"

# ASCII letters fold to lower case, every other ASCII character separates, bytes of other characters stay
FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
FOLDED = np.frombuffer(FOLD, np.uint8)


def byte_strings(array: pa.Array) -> list[bytes]:
    """The values of a binary array without nulls."""
    _, ends, body = array.buffers()
    if not len(array):
        return []
    ends = np.frombuffer(ends, np.int32)[array.offset:array.offset + len(array) + 1].tolist()
    return list(map((body.to_pybytes() if body else b"").__getitem__, map(slice, ends[:-1], ends[1:])))


def split_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, folded, and the number of terms of each text."""
    folded = FOLDED[data]
    inside = folded != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = offsets[:-1]
    starts = starts[starts < len(data)]
    first[starts] = inside[starts]
    at = np.flatnonzero(first)
    body = folded[inside]
    ends = np.append(np.cumsum(inside, dtype=np.int32)[at] - 1, len(body)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(body)])
    return words, np.diff(np.searchsorted(at, offsets))


def _summed(key: np.ndarray, *columns: np.ndarray):
    """Equal keys added up, in key order."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], *(np.add.reduceat(c[order], first) for c in columns)


class Block:
    """Postings of one block: numbers of (lang, source) group and term -> occurrences, documents."""

    def __init__(self):
        self.terms: dict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = self.loose = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, langs: list[str], sources: list[str]) -> None:
        """Index whole documents: their bytes one after another, and where each begins."""
        words, counts = split_terms(data, offsets)
        if not len(words):
            return
        # one look-up a distinct term of these documents
        found = words.dictionary_encode()
        known = np.fromiter(map(self.terms.__getitem__, byte_strings(found.dictionary)), np.int64, len(found.dictionary))
        term = known[np.asarray(found.indices)]
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources)], np.int64)
        key, n = _summed(np.repeat(np.arange(len(counts)), counts) << 32 | term, np.ones(len(term), np.int64))
        self.parts.append(_summed(group[key >> 32] << 32 | (key & 0xFFFFFFFF), n, np.ones(len(n), np.int64)))
        self.loose += len(self.parts[-1][0])
        if self.loose > 2 * self.size + 100_000:
            self.compact()

    def compact(self) -> None:
        if self.parts:
            self.parts = [_summed(*map(np.concatenate, zip(*self.parts)))]
            self.size = self.loose = len(self.parts[0][0])

    def run(self, number: int):
        """The block's postings in batches sorted by key: the language's name, then the term's bytes."""
        self.compact()
        if not self.parts:
            return
        key, n, docs = self.parts[0]
        terms = list(self.terms)
        in_order = sorted(range(len(terms)), key=terms.__getitem__)
        rank = np.empty(len(terms), np.int64)
        rank[in_order] = np.arange(len(terms))
        groups = list(self.groups)
        names = pa.array([source for _, source in groups], pa.string())
        langs = sorted({lang for lang, _ in groups}, key=str.encode)
        lang_of = np.array([langs.index(lang) for lang, _ in groups], np.int64)
        group, place = key >> 32, rank[key & 0xFFFFFFFF]
        order = np.lexsort((group, place, lang_of[group]))
        group, place, n, docs = group[order], place[order], n[order], docs[order]
        lang = lang_of[group]
        first = np.r_[np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (lang[1:] != lang[:-1])]), len(place)]
        heads = [x.encode() + b"\0" for x in langs]
        for i in range(0, len(first) - 1, 50_000):
            edge = first[i:i + 50_001]
            p = slice(int(edge[0]), int(edge[-1]))
            keys = [heads[x] + terms[in_order[r]] for x, r in zip(lang[edge[:-1]].tolist(), place[edge[:-1]].tolist())]
            yield _batch(keys, number, edge - edge[0], names.take(pa.array(group[p])), n[p], docs[p])


def _batch(keys, number, ends, sources, counts, docs) -> pa.RecordBatch:
    ends = pa.array(ends, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(np.full(len(keys), number, np.int64)),
         *(pa.ListArray.from_arrays(ends, c) for c in (sources, pa.array(counts), pa.array(docs)))],
        names=["key", "run", "sources", "counts", "docs"])


def _runs(block_size: int):
    def index(batches):
        from pyspark import TaskContext
        number, block = TaskContext.get().partitionId() << 32, Block()
        for b in batches:
            data, offsets = utf8(b.column(0))
            langs, sources = b.column(1).to_pylist(), b.column(2).to_pylist()
            for i, j in chunks(offsets, PIECE):
                block.add(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], langs[i:j], sources[i:j])
                if block.size >= block_size or len(block.terms) >= block_size:
                    yield from block.run(number)
                    number, block = number + 1, Block()
        yield from block.run(number)
    return index


def _order(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Heap merge of sorted stretches of keys: the rows in key order, and where each new key begins."""
    cuts = [0] + [i for i in range(1, len(keys)) if keys[i] < keys[i - 1]] + [len(keys)]
    order, first, last = [], [], None
    for k, i in merge(*(zip(keys[a:z], range(a, z)) for a, z in zip(cuts[:-1], cuts[1:]))):
        if k != last:
            first.append(len(order))
            last = k
        order.append(i)
    return np.array(order, np.int64), np.array(first, np.int64)


def _merged(table: pa.Table):
    """Keys of a shard's runs in order, with each one's sources, occurrences and documents summed: lists' ends and columns."""
    keys = byte_strings(table.column("key").combine_chunks())
    order, first = _order(keys)
    lists = [table.column(c).combine_chunks() for c in ("sources", "counts", "docs")]
    starts = np.asarray(lists[0].offsets)[:-1] - lists[0].offsets[0].as_py()
    sizes = np.asarray(lists[0].value_lengths()).astype(np.int64)[order]
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1])) + np.repeat(starts[order] - (ends - sizes), sizes)
    number = np.zeros(len(order), np.int64)
    number[first[1:]] = 1
    term = np.repeat(np.cumsum(number), sizes)
    names = lists[0].flatten().dictionary_encode()
    code = np.asarray(names.indices)[at].astype(np.int64)
    by = np.lexsort((code, term))
    term, code = term[by], code[by]
    new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (code[1:] != code[:-1])])
    counts, docs = (np.add.reduceat(c.flatten().to_numpy()[at][by], new) for c in lists[1:])
    return [keys[i] for i in order[first]], term[new], names.dictionary.take(pa.array(code[new])), counts, docs


def _shard(least_docs: int | None):
    """Merge the runs of a shard, group by group: into larger runs, or (``least_docs``) into frequencies of kept terms."""
    def combine(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        groups = table.column("run").to_numpy()
        for g in np.unique(groups):
            keys, term, sources, counts, docs = _merged(table.filter(pa.array(groups == g)))
            if least_docs is None:
                ends = np.r_[0, np.cumsum(np.bincount(term, minlength=len(keys)))]
                for i, j in chunks(ends, BATCH):
                    p = slice(int(ends[i]), int(ends[j]))
                    yield _batch(keys[i:j], int(g), ends[i:j + 1] - ends[i], sources[p], counts[p], docs[p])
                continue
            first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
            keep = np.flatnonzero((np.add.reduceat(docs, first) >= least_docs)[term])
            lang_count = np.add.reduceat(counts, first)[term]
            split = [k.rpartition(b"\0")[::2] for k in keys]
            for i in range(0, len(keep), BATCH):
                p = keep[i:i + BATCH]
                names = [split[t] for t in term[p]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in names], pa.binary()).cast(pa.string()), pa.array([x[1] for x in names], pa.binary()).cast(pa.string()),
                     sources.take(pa.array(p)), pa.array(counts[p]), pa.array(lang_count[p])],
                    names=["lang", "term", "source", "count", "lang_count"])
    return combine


def kept_frequencies(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                     least_docs: int = 3, block: int = BLOCK) -> DataFrame:
    """(lang, term, source, count, lang_count): occurrences of every kept term in every (lang, source) group that has it.

    Null text, lang and source count as ''. Terms are runs of ASCII letters,
    folded to lower case, and of characters outside ASCII; kept are those of
    ``least_docs`` documents of the language. A block's memory is bounded by
    ``block`` and one document. A shard merges SHARD_POSTINGS postings on
    average, whatever the corpus: the number of shards grows with the spilled
    runs, and a term has at most FAN_IN rows in a merge, however many runs hold it.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    runs = stored(rows.mapInArrow(_runs(block), RUN), "runs")
    while True:
        count, size = runs.agg(F.count_distinct("run"), F.coalesce(F.sum(F.size("counts")), F.lit(0))).first()
        shards = max(partitions(spark), -(-size // SHARD_POSTINGS))
        groups = -(-count // FAN_IN)
        grouped = runs.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(groups)) if groups > 1 else F.lit(0).cast("long"))
        if groups <= 1:
            return grouped.repartition(shards, "key").mapInArrow(_shard(least_docs), FREQUENCY)
        runs = stored(grouped.repartition(shards, "key", "run").mapInArrow(_shard(None), RUN), "merged")


def _share(count, total, terms):
    """1 + floor(ONE * (count + 1) / (total + terms)), exactly."""
    return F.expr(f"1 + (cast({ONE} as decimal(38, 0)) * ({count} + 1)) div ({total} + {terms})")


def _gap(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _corrections(batches):
    """Sums of corrections over the terms that two sources share: (lang, s, t, high, low).

    Rows arrive grouped by (lang, term), so a term's rows lie together. A
    correction is f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), where p0 and q0
    are the shares of a term that the source lacks. High and low are the sums
    of its quotients and remainders by 2**32, so no sum overflows.
    """
    held: dict[str, list] = {}

    def reduce(lang):
        parts = held.pop(lang)
        s, t, hi, lo = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((t, s))
        s, t = s[order], t[order]
        first = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (t[1:] != t[:-1])])
        return s[first], t[first], np.add.reduceat(hi[order], first), np.add.reduceat(lo[order], first)

    def emit(lang):
        s, t, hi, lo = reduce(lang)
        for i in range(0, len(s), 100_000):
            j = slice(i, i + 100_000)
            n = len(s[j])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), *(pa.array(c[j]) for c in (s, t, hi, lo))],
                                             names=["lang", "s", "t", "high", "low"])

    def expand(lang, term_of, code, p, p0):
        """Pairs of rows of one term, in pieces of at most PAIRS (or one row against a term's rows)."""
        first = np.flatnonzero(np.r_[True, term_of[1:] != term_of[:-1]])
        size = np.diff(np.r_[first, len(term_of)])
        k, start = np.repeat(size, size), np.repeat(first, size)
        ends = np.cumsum(k)
        i = 0
        while i < len(k):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, "right")))
            left = np.repeat(np.arange(i, j), k[i:j])
            right = np.arange(len(left)) - np.repeat(ends[i:j] - k[i:j] - (ends[i] - k[i]), k[i:j]) + np.repeat(start[i:j], k[i:j])
            other = left != right
            left, right = left[other], right[other]
            if len(left):
                d = (gaps(p[left], p[right]) - gaps(p[left], p0[right]) - gaps(p0[left], p[right]) + gaps(p0[left], p0[right]))
                held.setdefault(lang, []).append((code[left], code[right], d >> 32, d & 0xFFFFFFFF))
                if sum(len(x[0]) for x in held[lang]) > PAIRS:
                    got = reduce(lang)
                    held[lang] = [got]
                    if len(got[0]) > PAIRS // 2:
                        yield from emit(lang)
            i = j

    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        key = [np.asarray(t.column(c).combine_chunks().dictionary_encode().indices) for c in ("lang", "term")]
        change = np.flatnonzero((np.diff(key[0]) != 0) | (np.diff(key[1]) != 0)) + 1
        last = int(change[-1]) if len(change) else 0      # the last term may go on in the next batch
        rest = t.slice(last)
        yield from _pieces(t.slice(0, last), expand)
    if rest is not None:
        yield from _pieces(rest, expand)
    for lang in list(held):
        yield from emit(lang)


def _pieces(t: pa.Table, expand):
    if not t.num_rows:
        return
    lang = np.asarray(t.column("lang").combine_chunks().dictionary_encode().indices)
    term = np.asarray(t.column("term").combine_chunks().dictionary_encode().indices)
    names = t.column("lang").combine_chunks().dictionary_encode().dictionary.to_pylist()
    cut = np.r_[0, np.flatnonzero(np.diff(lang)) + 1, len(lang)]
    values = [t.column(c).to_numpy() for c in ("code", "p", "p0")]
    for a, z in zip(cut[:-1], cut[1:]):
        yield from expand(names[lang[a]], term[a:z], *(v[a:z] for v in values))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               least_docs: int = 3, top: int = 200, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group that occurs.

    A language keeps the terms of at least ``least_docs`` of its documents. A
    group gives each kept term the share 1 + floor(10**9 (count + 1) / (N + V)).
    Part `pair` lists the other sources of the language by the sum of
    floor((p - q)**2 / q) over all kept terms (0 without any), part `term` the
    group's terms with p above the language's q, at most ``top`` of them. Ranks
    run from 1, values descending, equal ones by the item's bytes. A language
    of one source has no pairs; an empty table gives no rows; repeated rows
    count as documents of their own; other columns are not read.

    Sums of shares are exact integers. The result holds every pair of sources
    of a language by contract; the work holds no more: for each term the
    sources that share it add to sums by pair inside a task.
    """
    kept = stored(kept_frequencies(docs, text_col, lang_col, source_col, least_docs, block), "kept")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    occurring = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("present"))
    # distinct terms of a language: each term's rows lie in one group, one of them is its first
    langs = (kept.groupBy("lang", "term").agg(F.first("lang_count").alias("c"))
             .groupBy("lang").agg(F.count("*").alias("v"), F.sum("c").alias("lang_n")))
    groups = stored(
        occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n", "present", "v", "lang_n")])
        .withColumn("code", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
        .withColumn("p0", F.when(F.col("v") > 0, _share("0", "n", "v"))), "groups")
    shares = kept.join(groups.drop("present"), ["lang", "source"]).withColumn("p", _share("count", "n", "v"))

    terms = (shares.withColumn("q", _share("lang_count", "lang_n", "v")).where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value")))

    # each source's terms against a source that lacks them, by distinct count, in both directions
    counts = shares.groupBy("lang", "code", "p", "p0").agg(F.count("*").alias("terms"))
    other = groups.select("lang", F.col("code").alias("t"), F.col("p0").alias("q0"))
    alone = counts.join(other, "lang").where("code <> t")
    weigh = lambda p, q: (F.col("terms").cast("decimal(19, 0)") * _gap(p, q).cast("decimal(19, 0)")).cast("decimal(38, 0)")
    one_way = alone.groupBy("lang", F.col("code").alias("s"), "t").agg(F.sum(weigh("p", "q0")).alias("part"))
    other_way = alone.groupBy("lang", F.col("t").alias("s"), F.col("code").alias("t")).agg(F.sum(weigh("q0", "p")).alias("part"))
    streamed = (shares.select("lang", "term", "code", "p", "p0")
                .repartition("lang", "term").sortWithinPartitions("lang", "term")
                .mapInArrow(_corrections, "lang string, s long, t long, high long, low long")
                .groupBy("lang", "s", "t")
                .agg((F.sum(F.col("high").cast("decimal(38, 0)")) * F.lit(1 << 32).cast("decimal(11, 0)")).cast("decimal(38, 0)").alias("h"),
                     F.sum(F.col("low").cast("decimal(38, 0)")).alias("l"))
                .select("lang", "s", "t", (F.col("h") + F.col("l")).cast("decimal(38, 0)").alias("part")))
    sums = (one_way.unionByName(other_way).unionByName(streamed)
            .groupBy("lang", "s", "t").agg(F.sum("part").alias("sum")))
    left = groups.select("lang", "source", F.col("code").alias("s"), "v", F.col("present").alias("has_s"), F.col("p0").alias("a"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("code").alias("t"), F.col("present").alias("has_t"), F.col("p0").alias("b"))
    rest = ((F.col("v") - F.col("has_s") - F.col("has_t")).cast("decimal(19, 0)") * _gap("a", "b").cast("decimal(19, 0)")).cast("decimal(38, 0)")
    zero = F.lit(0).cast("decimal(38, 0)")
    pairs = (left.join(right, "lang").where("s <> t").join(sums, ["lang", "s", "t"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (F.coalesce(F.col("sum"), zero) + F.coalesce(rest, zero)).cast("long").alias("value")))

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))
