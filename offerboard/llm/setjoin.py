"""Exact Jaccard join of shingle sets by universe partition and pigeonhole (operator 9).

Shingles are hashed into the segments of their document's size band. Two sets
whose similarity reaches the threshold differ in so few shingles that some
segment must be equal, or, in bands that index one-deletion neighbourhoods,
differ in one shingle at most. Segments' subsets are therefore indexed by
hash; documents that share an index entry are candidates and are verified
exactly on their whole sets.

Allocation by cost: a document meets its partners with certainty when the
entries it relies on cover one difference more than the threshold allows. It
indexes all its non-empty segments in its own band, and in the band below only
as many as it needs, the fullest first, since full segments are the rarest.
Entries that many documents share (copies, common passages) are too costly to
pair up: their members are compared with one of them only, and a document loses
the cover of such an entry. A document that loses too much looks through as many
of its rarest costly entries as it is short of: a few times at one member, drawn
anew, which connects large groups in linear work, and at last at all members
outside its own group. Groups already connected need no more pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, mix, partitions, ship, stored, utf8, word_marks
from .components import connected_components

ship(__name__)

WORDS = 5                # words of a shingle
LIGHT = 8                # members of an index entry that are paired with each other
DELETIONS_TO = 16        # bands up to this size index one-deletion neighbourhoods
FILL = 0.4               # segments of a band as a share of its largest size
FLUSH = 2_000_000        # index entries a task holds before it sends them
STARS = 1                # rounds that compare the members of costly entries with one of them, before all are
PAIRS_A_CHUNK = 64       # partners of one document verified in one piece of work


def bands(largest: int) -> np.ndarray:
    """Band boundaries: each at least 4/3 of the one before, so that a partner lies in the same or the next band."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-out[-1] * 4 // 3)))
    return np.array(out, np.int64)


BANDS = bands(1 << 40)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts, ascending within each text, and the n + 1 set offsets.

    A text of fewer words is one shingle, its whole sequence; a text without
    words has an empty set.
    """
    w, at = word_marks(data, offsets)
    count = np.diff(at)
    n = len(count)
    doc = np.repeat(np.arange(n), count)
    size = np.minimum(count, words)[doc]                 # words of the shingle that starts here
    left = at[1:][doc] - np.arange(len(w))
    starts = np.flatnonzero(left >= size)
    starts = starts[(size[starts] == words) | (left[starts] == count[doc[starts]])]
    h = size[starts].astype(np.uint64)
    for k in range(words):
        more = k < size[starts]
        h = np.where(more, h * np.uint64(0x9FB21C651E98DF25) + w[np.minimum(starts + k, max(len(w) - 1, 0))], h)
    h = mix(h)
    owner = doc[starts]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    return h, np.r_[0, np.cumsum(np.bincount(owner, minlength=n))]


def differences(a: int, b: int) -> int:
    """Shingles in which sets of a and b members may differ at a similarity of 0.75."""
    return (a + b) // 7


def entries(u: np.ndarray, band: int, own: bool) -> tuple[np.ndarray, int]:
    """Index entries of a set (ascending hashes) in a band, and the cover it has beyond its need (negative: too little)."""
    n, high = len(u), int(BANDS[band + 1]) - 1
    deletions = high <= DELETIONS_TO
    m = int(np.ceil(FILL * high)) + 8
    if deletions:
        m = m // 2 + 1
    # in its own band a document's partners may be larger, in the band below they are within it
    need = differences(n, 4 * n // 3 if own else high) + 1
    segment = (u >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
    first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    size = np.diff(np.r_[first, n])
    code = mix(u)
    sums = np.add.reduceat(code, first)
    salt = mix(segment[first] * np.uint64(1 << 8) + np.uint64(band))
    exact = mix(sums ^ salt)
    if not deletions:
        if not own and len(exact) > need:
            slack = need // 16 + 2
            fullest = np.argsort(-size, kind="stable")[:need + slack]
            return exact[fullest], len(fullest) - need
        return exact, len(exact) - need
    cover = int(np.minimum(size, 2).sum()) - need
    wide = np.repeat(size > 1, size)
    whose = np.repeat(np.arange(len(first)), size)[wide]
    less = mix((sums[whose] - code[wide]) ^ salt[whose])
    return np.r_[exact, less], cover


def parity(u: np.ndarray) -> np.ndarray:
    """Parity sketch of a set: bit k tells whether an odd number of members fall on k; four to eight bits a member.

    The bits in which two sketches differ never outnumber the members in which
    the sets differ. A sketch of twice the size folds onto the smaller by XOR
    of its halves.
    """
    bits = max(64, 4 << (len(u) - 1).bit_length())
    odd = np.bincount((u & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _classes(docs: DataFrame) -> DataFrame:
    """(id, n, f, g, sketch): size, 128-bit fingerprint and parity sketch of the set of every row."""
    def work(batches):
        for b in batches:
            data, offsets = utf8(b.column(1))
            n, f, g, sketch = [], [], [], []
            for i, j in chunks(offsets):
                u, at = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                size = np.diff(at)
                total = np.zeros((2, j - i), np.uint64)
                if len(u):
                    some = size > 0
                    total[0, some] = np.add.reduceat(mix(u), at[:-1][some])
                    total[1, some] = np.add.reduceat(mix(u ^ np.uint64(0x5BD1E995)), at[:-1][some])
                n.append(size)
                f.append(total[0].view(np.int64))
                g.append(total[1].view(np.int64))
                sketch += [parity(u[x:y]) if y > x else None for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (n, f, g)),
                                              pa.array(sketch, pa.list_(pa.int64()))], names=["id", "n", "f", "g", "sketch"])

    return docs.mapInArrow(work, f"id {dict(docs.dtypes)['id']}, n long, f long, g long, sketch array<long>")


def _star(code: np.ndarray, doc: np.ndarray, ids: np.ndarray, kind: np.ndarray, size: np.ndarray, known: np.ndarray):
    """Candidates among entries held together: pairs of ids, and the rows of costly entries with their first members.

    Entries of up to LIGHT members pair all of them, unless ``known`` marks a
    code as costly; a costly entry's members are compared with the smallest id
    of its own band alone. Returns (pairs, rows that are costly, first rows of
    the costly entries); rows index ``code`` and ``doc``.
    """
    order = np.lexsort((ids[doc], kind[doc], code))
    run = np.cumsum(np.r_[True, code[order][1:] != code[order][:-1]]) - 1 if len(order) else order
    length = np.bincount(run) if len(order) else order
    many = (length > LIGHT) | (np.bincount(run, known[order]) > 0) if len(order) else np.empty(0, bool)
    alone = (length == 1) & ~many
    order, run = order[~alone[run]], run[~alone[run]]
    many = many[run]
    a, b = [], []
    for step in range(1, LIGHT):
        i = np.flatnonzero((run[step:] == run[:-step]) & ~many[step:])
        a.append(order[i])
        b.append(order[i + step])
    head = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else run
    first = np.repeat(order[head], np.diff(np.r_[head, len(run)]))
    a, b = np.concatenate([*a, first[many]]), np.concatenate([*b, order[many]])
    a, b = doc[a], doc[b]
    fit = (ids[a] != ids[b]) & ((kind[a] == 0) | (kind[b] == 0))
    fit &= 4 * np.minimum(size[a], size[b]).astype(np.int64) >= 3 * np.maximum(size[a], size[b])
    a, b = ids[a[fit]], ids[b[fit]]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pairs, order[many], order[head][many[head]]


BLOB = ("ids", "sizes", "kinds", "slacks", "counts", "codes", "hot", "pairs", "costly", "costly_codes")


def _index(docs: DataFrame, pieces: int) -> DataFrame:
    """Index entries of many documents for one piece of the index, a row each, as packed arrays.

    Entries cost four bytes and no row of their own. Kind 0 is a document in
    its own band, kind 1 one that looks into the band below. Entries that many
    of a task's documents share are combined before the shuffle: their members
    are compared here, and only the first goes on, marked hot. A group of
    copies, however large, thus sends a few members a task.
    """
    def work(batches):
        held: list[tuple] = []
        total = 0

        def flush():
            codes = np.concatenate([c for _, _, _, _, c in held])
            owner = np.repeat(np.arange(len(held)), [len(c) for *_, c in held])
            ids = np.array([x[0] for x in held], np.int64)
            size, kind, slack = (np.array([x[k] for x in held], t) for k, t in ((1, np.int32), (2, np.int8), (3, np.int32)))
            place = ((codes >> np.uint64(32)) % np.uint64(pieces)).astype(np.int32)
            codes = codes.astype(np.uint32)
            order = np.lexsort((codes, place))
            place, codes, owner = place[order], codes[order], owner[order]
            # entries shared by more than LIGHT documents here
            new = np.r_[True, (codes[1:] != codes[:-1]) | (place[1:] != place[:-1])]
            run = np.cumsum(new) - 1
            many = (np.bincount(run) > LIGHT)[run]
            cuts = np.r_[0, np.flatnonzero(np.diff(place)) + 1, len(place)]
            rows = []
            for i, j in zip(cuts[:-1], cuts[1:]):
                c, o, hot = codes[i:j], owner[i:j], many[i:j]
                pairs, members, heads = _star(c[hot], o[hot], ids, kind, size, np.zeros(hot.sum(), bool))
                hot_c, hot_o = c[hot], o[hot]
                go_c, go_o = np.r_[c[~hot], hot_c[heads]], np.r_[o[~hot], hot_o[heads]]
                order = np.lexsort((go_c, go_o))
                go_c, go_o = go_c[order], go_o[order]
                who, count = np.unique(go_o, return_counts=True)
                rest = np.stack([ids[hot_o[members]], size[hot_o[members]], kind[hot_o[members]], slack[hot_o[members]]])
                rows.append((int(place[i]), ids[who], size[who], kind[who], slack[who], count.astype(np.int32), go_c,
                             hot_c[heads], pairs, rest.astype(np.int64), hot_c[members]))
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32())] + [pa.array([x.tobytes() for x in c], pa.binary()) for c in cols[1:]],
                names=["piece", *BLOB])

        for b in batches:
            b = b.filter(b.column(0).is_valid())
            keys = b.column(0).to_numpy()
            data, offsets = utf8(b.column(1))
            for i, j in chunks(offsets):
                u, at = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for r in range(j - i):
                    s = u[at[r]:at[r + 1]]
                    n = len(s)
                    if not n:
                        continue
                    band = int(np.searchsorted(BANDS, n, "right")) - 1
                    own, slack = entries(s, band, True)
                    if slack < 0:       # too little cover: an entry that all such documents of the band share
                        own = np.r_[own, mix(np.array([band + (1 << 40)], np.uint64))]
                    held.append((keys[i + r], n, 0, slack, own))
                    total += len(own)
                    if band and -(-3 * n // 4) < BANDS[band]:
                        low, slack = entries(s, band - 1, False)
                        if slack < 0:
                            low = np.r_[low, mix(np.array([band - 1 + (1 << 40)], np.uint64))]
                        held.append((keys[i + r], n, 1, slack, low))
                        total += len(low)
                    if total > FLUSH:
                        yield flush()
                        held, total = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(work, "piece int, " + ", ".join(f"{c} binary" for c in BLOB))


def _pairs(index: DataFrame) -> DataFrame:
    """Candidates of each piece: pairs (a, b), and members of costly entries (entry, a, kind, size, slack, unit)."""
    def work(piece: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.concatenate([np.frombuffer(x, kind) for x in piece.column(name).to_pylist()])

        ids, size, kind, slack, count = (joined(c, t) for c, t in (
            ("ids", np.int64), ("sizes", np.int32), ("kinds", np.int8), ("slacks", np.int32), ("counts", np.int32)))
        code = joined("codes", np.uint32)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), count)
        hot = np.unique(joined("hot", np.uint32))
        # only codes that occur twice, or that a task found hot, matter
        order = np.argsort(code, kind="stable")
        code, doc = code[order], doc[order]
        same = code[1:] == code[:-1]
        known = np.isin(code, hot)
        some = np.r_[same, False] | np.r_[False, same] | known
        code, doc, known = code[some], doc[some], known[some]
        pairs, members, _ = _star(code, doc, ids, kind, size, known)
        pairs = np.unique(np.concatenate([pairs, joined("pairs", np.int64).reshape(-1, 2)]), axis=0)
        before = [np.frombuffer(x, np.int64).reshape(4, -1) for x in piece.column("costly").to_pylist()]
        who = doc[members]
        late = np.stack([ids[who], size[who], kind[who], slack[who]]).astype(np.int64)
        held = np.concatenate([*before, late], 1)
        codes = np.concatenate([joined("costly_codes", np.uint32), code[members]]).astype(np.int64)
        # the first member of a task's hot entry comes both ways
        held, codes = held[:, (at := np.unique(np.r_[codes[None], held], axis=1, return_index=True)[1])], codes[at]
        entry = (codes << 24) + int(piece.column("piece")[0].as_py())
        n, m = len(pairs), len(codes)
        unit = np.where(held[1] <= 2 * DELETIONS_TO, 2, 1)
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.table({
            "a": pa.concat_arrays([pa.array(pairs[:, 0]), pa.array(held[0])]),
            "b": pa.concat_arrays([pa.array(pairs[:, 1]), none(m)]),
            **{c: pa.concat_arrays([none(n), pa.array(x.astype(np.int64))]) for c, x in (
                ("entry", entry), ("kind", held[2]), ("size", held[1]), ("slack", held[3]), ("unit", unit))}})

    return index.groupBy("piece").applyInArrow(
        work, "a long, b long, entry long, kind long, size long, slack long, unit long")


def _differ(one: str, two: str) -> Column:
    """Bits in which two sketches differ, the larger folded onto the smaller."""
    def folded(x, y):
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, F.lit(1), F.size(y)), F.slice(x, F.size(y) + 1, F.size(y)),
                                                        lambda p, q: p.bitwiseXOR(q))).otherwise(x)
    return F.aggregate(F.zip_with(folded(F.col(one), F.col(two)), folded(F.col(two), F.col(one)),
                                  lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda a, x: a + x)


def verified(docs: DataFrame, pairs: DataFrame, sketches: DataFrame, purpose: str) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets reach 100 * intersection >= 75 * union, on whole sets.

    Pairs whose sketches alone differ in more members than the threshold
    allows go first. Partners of a document are verified in chunks of about
    PAIRS_A_CHUNK: its set travels once a chunk, so a document with many
    partners is many tasks' work.
    """
    spark = docs.sparkSession
    one, two = (sketches.select(F.col("id").alias(c), F.col("n").alias("n" + k), F.col("sketch").alias("s" + k))
                for c, k in (("a", "1"), ("b", "2")))
    near = F.coalesce(7 * _differ("s1", "s2") <= F.col("n1") + F.col("n2"), F.lit(True))
    pairs = stored(pairs.join(one, "a").join(two, "b").where(near).select("a", "b"), purpose + "-pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()

    def sets(batches):
        for b in batches:
            data, offsets = utf8(b.column(1))
            out = []
            for i, j in chunks(offsets):
                u, at = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                out += [u[at[r]:at[r + 1]].tobytes() for r in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["id", "u"])

    # the comparison lets Spark build a Bloom filter of a small list of ids and drop other texts before they are shuffled
    wanted = stored(wanted.withColumn("round", F.lit(1)), purpose + "-wanted").where("round = 1")
    known = stored(docs.join(wanted, "id", "left_semi").mapInArrow(sets, "id long, u binary"), purpose + "-sets")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_A_CHUNK).alias("parts"))
    salted = stored(pairs.join(stored(many, purpose + "-many"), "a")
                    .select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part")), purpose + "-salted")
    number = F.pmod(F.xxhash64("a", "part"), F.lit(8 * partitions(spark))).cast("int").alias("piece")
    left = (salted.select("a", "part").distinct().join(known, F.col("a") == F.col("id"))
            .select(number, "a", "part", F.lit(None).cast("long").alias("b"), "u"))
    right = salted.join(known, F.col("b") == F.col("id")).select(number, "a", "part", "b", "u")

    def compare(t: pa.Table) -> pa.Table:
        a, part, b = t.column("a").to_pylist(), t.column("part").to_pylist(), t.column("b").to_pylist()
        u = t.column("u").to_pylist()
        base = {(x, p): np.frombuffer(s, np.uint64) for x, p, y, s in zip(a, part, b, u) if y is None}
        out = []
        for x, p, y, s in zip(a, part, b, u):
            if y is None or (x, p) not in base:
                continue
            one, two = base[x, p], np.frombuffer(s, np.uint64)
            at = np.minimum(np.searchsorted(one, two), len(one) - 1)
            both = int((one[at] == two).sum())
            if 100 * both >= 75 * (len(one) + len(two) - both):
                out.append((x, y))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return stored(left.union(right).groupBy("piece").applyInArrow(compare, "a long, b long"), purpose + "-links")


def _open_entries(member: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of the costly entries that join several groups and hold a document short of cover.

    ``asks`` marks the entries a document looks through: the rarest ones, as
    many as it is short of.
    """
    own = stored(member.join(groups, F.col("id") == F.col("node"), "left")
                 .withColumn("component", F.coalesce("component", "id")).drop("node"), "grouped")
    open_ = (own.groupBy("entry").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("many"),
                                      F.max("short").alias("most"), F.max(F.when(F.col("kind") == 1, F.col("short"))).alias("below"))
             .where("low < high and most > 0").select("entry", "many", (F.coalesce("below", F.lit(0)) > 0).alias("below")))
    rest = own.join(stored(open_, "entries"), "entry").where("short > 0 or (below and kind = 0)").drop("below")
    place = F.row_number().over(Window.partitionBy("id", "kind").orderBy("many", "entry"))     # entries of one document
    rest = stored(rest.withColumn("asks", place <= F.col("short")).drop("many"), "asking")
    asked = stored(rest.where("asks").select("entry").distinct(), "asked")
    return rest.join(asked, "entry")


def _looks(rest: DataFrame, others: DataFrame, last: bool) -> DataFrame:
    """Distinct pairs (a, b) of documents that ask and others of their entries, in other groups.

    In the ``last`` turn both sides carry sketches, so that documents too
    different are no rows of the join, and two documents that both ask are
    paired from one side only.
    """
    more = ["n", "sketch"] if last else []
    left, right = (df.select("entry", *[F.col(c).alias(c + k) for c in ("id", "kind", "size", "short", "component", "asks", *more)])
                   for df, k in ((rest, "1"), (others, "2")))
    fit = F.expr(f"component1 <> component2 and kind2 = 0 and (kind1 = 1 or (short2 > 0 and {'id1 < id2' if last else 'true'}))"
                 " and 4 * least(size1, size2) >= 3 * greatest(size1, size2)")
    if last:
        fit &= F.coalesce(7 * _differ("sketch1", "sketch2") <= F.col("n1") + F.col("n2"), F.lit(True))
    return (left.where("asks1").join(right, (left["entry"] == right["entry"]) & fit)
            .select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")).distinct())


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row; component_id is the smallest id reachable by links.

    Words are lower-cased (A-Z) runs of other than ASCII white space. Null,
    empty and blank texts have an empty set and link with nothing. Rows of
    equal sets are one class from the start (their links need no search), so a
    text that a third of all rows share is one row of the work. Ids must be
    integers; rows with a null id link with nothing; rows that share an id are
    one document. An empty table gives no rows. No entry, partner or candidate
    is dropped: what the first round leaves open the later ones settle.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = stored(_classes(rows), "sets")
    named = stored(known.where("n > 0 and id is not null").groupBy("f", "g", "n").agg(F.min("id").alias("rep")), "reps")
    rep_of = stored(known.join(named, ["f", "g", "n"]).groupBy("id").agg(F.min("rep").alias("rep")), "rep-of")
    # an id that stands for several sets has no sketch
    sketches = stored(known.where("n > 0 and id is not null").groupBy("id").agg(
        F.max("n").alias("n"), F.when((F.min("f") == F.max("f")) & (F.min("g") == F.max("g")), F.first("sketch")).alias("sketch"))
        .join(rep_of.where("id = rep").select("id"), "id", "left_semi"), "sketches")
    found = stored(_pairs(_index(rows, partitions(spark))), "candidates")
    rep_a, rep_b = (rep_of.select(F.col("id").alias(c), F.col("rep").alias("rep_" + c)) for c in "ab")
    tried = stored(found.where("b is not null").select("a", "b").distinct().join(rep_a, "a").join(rep_b, "b")
                   .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).where("a <> b").distinct(), "tried")
    links = verified(rows, tried, sketches, "first")
    groups = stored(connected_components(links), "groups")
    # members of costly entries, and how much cover each must win back from them (short > 0)
    costly = stored(found.where("entry is not null").join(rep_a, "a")
                    .groupBy("entry", F.col("rep_a").alias("id"), "kind").agg(
                        F.max("size").alias("size"), F.min("slack").alias("slack"), F.max("unit").alias("unit")), "costly")
    loss = costly.groupBy("id", "kind").agg((F.count("*") * F.max("unit") - F.greatest(F.min("slack"), F.lit(0))).alias("short"))
    member = stored(costly.select("entry", "id", "kind", "size").join(stored(loss, "loss"), ["id", "kind"]), "members")
    for turn in range(STARS + 1):
        rest = stored(_open_entries(member, groups), "open")
        if not rest.head(1):
            break
        if turn < STARS:
            pairs = _looks(rest, stored(rest.where("kind = 0").withColumn("far", F.xxhash64("id", F.lit(turn)))
                                        .groupBy("entry").agg(F.min_by(F.struct(*[c for c in rest.columns if c != "entry"]), "far").alias("x"))
                                        .select("entry", "x.*"), "centres"), False)
        else:
            rest = stored(rest.join(sketches.select("id", "n", "sketch"), "id"), "sketched")
            pairs = _looks(rest, rest, True)
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "looks")
        more = verified(rows, pairs, sketches, f"turn-{turn}")
        tried = tried.union(pairs)
        if more.head(1):
            # the groups so far are stars that connect what their links connected
            groups = stored(connected_components(groups.toDF("a", "b").union(more)), "groups")
    whole = stored(named.join(groups, F.col("rep") == F.col("node"), "left")
                   .select("f", "g", "n", F.coalesce("component", "rep").alias("component")), "whole")
    return (known.join(whole, ["f", "g", "n"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))
