"""Personal data by base patterns and bootstrapped contexts (operator 10).

Base patterns find the seed entities. The words around them are lexical
patterns; looser candidate shapes seen in the same contexts are instances. A
few rounds of joins and sums over the pattern-instance graph score both: a
pattern is as good as its instances, an instance as good as its patterns.
Patterns of high confidence make the candidates they surround new entities.

Only DataFrame functions are used: no Python worker, pandas, Arrow or RDD.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")

# Base shapes. Possessive quantifiers and look-behinds keep them linear on long runs; they match what the
# plain forms match, leftmost and without overlap.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A text without this shape has no match of the kind.
HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){15}", "phone": r"\+[0-9]"}

# Looser shapes of the same kinds: identifiers the base shapes or their checks do not admit.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@| ?[\[({] ?at ?[\])}] ?| at )[A-Za-z0-9-]++"
             r"(?:(?:\.| ?[\[({] ?dot ?[\])}] ?| dot )[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}+(?:(?:\.| ?[\[({](?:\.|dot)[\])}] ?)[0-9]{1,3}+){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9]++(?:[ -][0-9]++)*+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])[+(]?[0-9][ ()./0-9-]{5,}[0-9](?![0-9A-Za-z])",
}
LOOSE_HINT = {"email": r"@|[\[({ ]at[\])} ]", "ip": r"[0-9](?:\.| ?[\[({])", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"[0-9](?:[ ()./-]*[0-9]){6}"}

SEEDS = 3            # distinct seed entities a pattern needs
CONFIDENCE = 0.7     # of a pattern that makes new entities
ROUNDS = 3           # of scoring
BEFORE, AFTER = 60, 40   # characters of context around a match; one more tells that a word may be cut
CHUNK = 4096         # characters: spans are cut out of pieces of this size


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(total, i):
        d = F.substring(back, i, 1).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _ip_ok(x: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    return x.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _card_ok(x: Column) -> Column:
    d = _digits(x)
    return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)


CHECK = {
    "email": lambda x: F.lit(True),
    "ip": _ip_ok,
    "card": _card_ok,
    "phone": lambda x: F.length(_digits(x)).between(8, 15),
}
LOOSE_CHECK = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: F.lit(True),
    "card": lambda x: F.length(_digits(x)).between(12, 19),
    "phone": lambda x: F.length(_digits(x)).between(7, 15),
}


def _substring(x: Column, pos: Column | int, size: Column | int) -> Column:
    as_col = lambda v: F.lit(v) if isinstance(v, int) else v.cast("int")
    return F.substring(x, as_col(pos), as_col(size))


def matches(text: Column, shape: str, hint: str) -> Column:
    """Array of (start, end, match, before, after) of all matches, in code points; linear but for a square root.

    The text is split at the matches: the pieces and the matches, by turns,
    give the positions. Running sums are taken within blocks of about the
    square root of the number of matches, so that texts of very many matches
    stay cheap.
    """
    kind = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"
    parts, hits = F.split(text, shape, -1), F.regexp_extract_all(text, F.lit(shape), F.lit(0))
    data = F.array(F.struct(parts.alias("parts"), hits.alias("hits")))

    def with_sizes(d):
        n = F.size(d["hits"])
        return F.struct(d["parts"].alias("parts"), d["hits"].alias("hits"),
                        F.transform(F.sequence(F.lit(0), n - 1),
                                    lambda i: F.length(F.get(d["parts"], i)) + F.length(F.get(d["hits"], i))).alias("steps"),
                        F.ceil(F.sqrt(n)).cast("int").alias("width"))

    def with_blocks(d):
        blocks = F.ceil(F.size(d["steps"]) / d["width"]).cast("int")
        sums = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.aggregate(
            F.slice(d["steps"], b * d["width"] + 1, d["width"]), F.lit(0).cast("bigint"), lambda a, x: a + x))
        return F.struct(d["parts"].alias("parts"), d["hits"].alias("hits"), d["steps"].alias("steps"),
                        d["width"].alias("width"), sums.alias("sums"))

    def with_bases(d):
        return F.struct(d["parts"].alias("parts"), d["hits"].alias("hits"), d["steps"].alias("steps"), d["width"].alias("width"),
                        F.transform(d["sums"], lambda _, b: F.when(b > 0, F.aggregate(
                            F.slice(d["sums"], F.lit(1), b), F.lit(0).cast("bigint"), lambda a, x: a + x)).otherwise(0)).alias("bases"))

    def spans(d):
        def one(hit, i):
            block, place = F.floor(i / d["width"]).cast("int"), i % d["width"]
            inside = F.when(place > 0, F.aggregate(F.slice(d["steps"], block * d["width"] + 1, place),
                                                   F.lit(0).cast("bigint"), lambda a, x: a + x)).otherwise(0)
            start = F.get(d["bases"], block) + inside + F.length(F.get(d["parts"], i))
            return F.struct(start.cast("bigint").alias("start"), (start + F.length(hit)).cast("bigint").alias("end"),
                            hit.alias("match"), F.right(F.get(d["parts"], i), F.lit(BEFORE + 1)).alias("before"),
                            F.left(F.get(d["parts"], i + 1), F.lit(AFTER + 1)).alias("after"))
        return F.transform(d["hits"], one)

    some = F.filter(data, lambda d: F.size(d["hits"]) > 0)
    found = F.transform(F.transform(F.transform(F.transform(some, with_sizes), with_blocks), with_bases), spans)
    return F.when(text.rlike(hint), F.coalesce(F.get(found, F.lit(0)), F.array().cast(kind))).otherwise(F.array().cast(kind))


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end) of all base matches, by kind as listed, then start."""
    def of(i, k):
        good = F.filter(matches(text, BASE[k], HINT[k]), lambda m: CHECK[k](m["match"]))
        return F.transform(good, lambda m: F.struct(F.lit(i).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
                           ).cast("array<struct<kind:int,start:bigint,end:bigint>>")

    return F.concat(*[of(i, k) for i, k in enumerate(KINDS)])


def _words(x: Column) -> Column:
    """Words of a context, lower-cased, without outer punctuation."""
    return F.filter(F.transform(F.split(F.lower(x), r"\s+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")),
                    lambda w: w != "")


def candidates(text: Column) -> Column:
    """Array of (kind, start, end, seed, instance, patterns) of all loose matches.

    Patterns are the two words before, the one before with the one after, and
    the two after; the instance is the match without separators.
    """
    kind = "array<struct<kind:int,start:bigint,end:bigint,seed:boolean,instance:string,patterns:array<string>>>"

    def one(m, i, k):
        # an outer word that the window may have cut does not count
        left = _words(F.when(F.length(m["before"]) > BEFORE, F.regexp_replace(m["before"], r"^\S*\s", "")).otherwise(m["before"]))
        right = _words(F.when(F.length(m["after"]) > AFTER, F.regexp_replace(m["after"], r"\s\S*$", "")).otherwise(m["after"]))
        last = lambda a, n: F.array_join(F.slice(a, F.greatest(F.size(a) - n + 1, F.lit(1)), F.lit(n)), " ")
        two, one_, next_ = last(left, 2), last(left, 1), F.get(right, F.lit(0))
        pats = F.filter(F.array(F.when(F.size(left) >= 2, F.concat(two, F.lit(" _"))),
                                F.when((F.size(left) >= 1) & (F.size(right) >= 1), F.concat(one_, F.lit(" _ "), next_)),
                                F.when(F.size(right) >= 2, F.concat(F.lit("_ "), F.array_join(F.slice(right, 1, 2), " ")))),
                        lambda p: p.isNotNull())
        seed = m["match"].rlike("^(?:" + BASE[k].replace(r"\G|", "") + ")$") & CHECK[k](m["match"])
        return F.struct(F.lit(i).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                        F.coalesce(seed, F.lit(False)).alias("seed"),
                        F.regexp_replace(F.lower(m["match"]), r"[ ().\[\]{}/+-]", "").alias("instance"), pats.alias("patterns"))

    def of(i, k):
        good = F.filter(matches(text, LOOSE[k], LOOSE_HINT[k]), lambda m: LOOSE_CHECK[k](m["match"]))
        return F.transform(good, lambda m: one(m, i, k)).cast(kind)

    return F.concat(*[of(i, k) for i, k in enumerate(KINDS)])


def score_patterns(seen: DataFrame, rounds: int = ROUNDS, seeds: int = SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """(kind, pattern, conf) of high confidence from occurrences (kind, pattern, instance, seed).

    Instances start at 1 (seed entities) or 0. Each round a pattern's
    confidence is the mean score of its distinct instances, and an unseen
    instance's score that of its best pattern that ``seeds`` seed entities
    support. Sums and maxima combine before the shuffle, so a frequent pattern
    or instance is no large group.
    """
    links = seen.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"))
    # patterns without enough seed entities never make an entity and take no further part
    backed = links.where("seed").groupBy("kind", "pattern").agg(F.count("*").alias("n")).where(F.col("n") >= seeds).drop("n")
    links = stored(stored(links, "links").join(stored(backed, "backed"), ["kind", "pattern"]), "graph")
    score = links.withColumn("score", F.col("seed").cast("double"))
    for _ in range(rounds):
        conf = stored(score.groupBy("kind", "pattern").agg(F.avg("score").alias("conf")), "patterns")
        best = stored(links.join(conf, ["kind", "pattern"]).groupBy("kind", "instance").agg(F.max("conf").alias("best")), "instances")
        score = (links.join(best, ["kind", "instance"])
                 .withColumn("score", F.when(F.col("seed"), 1.0).when(F.col("best") >= confidence, F.col("best")).otherwise(0.0)))
    return score.groupBy("kind", "pattern").agg(F.avg("score").alias("conf")).where(F.col("conf") >= confidence)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, seeds: int = SEEDS,
             confidence: float = CONFIDENCE) -> DataFrame:
    """(id, mark, base, spans): base spans and all spans (kind, start, end) of every row; ``mark`` hashes the text.

    Positions count code points from 0, ends are exclusive, kinds are indices
    into KINDS. ``base`` lies by kind, then start; ``spans`` adds the entities
    that high-confidence contexts discover and that overlap no base span nor an
    earlier discovered one, in the same order. Null and empty texts have no
    spans; repeated rows give repeated results; an empty table gives none.
    Texts are read once, whole; only spans and contexts are shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = stored(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"),
                              base_spans(text).alias("base"), candidates(text).alias("cands")), "spans")
    new = _discovered(read, rounds, seeds, confidence)
    return (read.select("id", "mark", "base")
            .join(new, F.col("id").eqNullSafe(F.col("new_id")) & (F.col("mark") == F.col("new_mark")), "left")
            .select(F.col("id").alias(id_col), "mark", "base", _all_spans().alias("spans")))


def _all_spans() -> Column:
    """Base and new spans by kind, then start."""
    both = F.concat("base", F.coalesce("new", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))
    return F.when(F.col("new").isNull(), F.col("base")).otherwise(F.array_sort(both))


def _discovered(read: DataFrame, rounds: int, seeds: int, confidence: float) -> DataFrame:
    """(new_id, new_mark, new): the spans that contexts discover, of the texts that have some."""
    seen = read.select(F.explode("cands").alias("c")).select("c.kind", "c.instance", "c.seed", F.explode("c.patterns").alias("pattern"))
    good = stored(score_patterns(seen, rounds, seeds, confidence), "good")
    clear = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    open_ = (read.select("id", "mark", F.filter("cands", lambda c: ~c["seed"] & clear(c)).alias("cands"))
             .where(F.size("cands") > 0).distinct())
    hits = (open_.select("id", "mark", F.explode("cands").alias("c"))
            .select("id", "mark", "c.kind", "c.start", "c.end", F.explode("c.patterns").alias("pattern")))
    new = (stored(hits, "open").join(good, ["kind", "pattern"])
           .groupBy("id", "mark", "kind", "start", "end").agg(F.max("conf").alias("conf"))
           .groupBy("id", "mark").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "conf"))).alias("new")))
    # of overlapping new spans the first stays (then the kind listed first)
    first = F.aggregate("new", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"), lambda a, x: F.when(
        (F.size(a) == 0) | (F.get(a, F.size(a) - 1)["end"] <= x["start"]),
        F.concat(a, F.array(F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))).otherwise(a))
    return stored(new.select(F.col("id").alias("new_id"), F.col("mark").alias("new_mark"), first.alias("new")), "new")


def redact_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
                     rounds: int = ROUNDS, seeds: int = SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """``docs`` with the spans of ``find_pii`` replaced in their texts; ``length_col`` follows the text.

    A row and its base spans stay together, written once, so only the texts
    that hold candidates beside them meet the discovered spans in a join; all
    others are not shuffled. Rows stay as they are otherwise, repeated ones and
    those without an id included.
    """
    own = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = stored(docs.select(F.struct(*own).alias("doc"), F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"),
                              base_spans(text).alias("base"), candidates(text).alias("cands")), "to-redact")
    new = _discovered(read.select("id", "mark", "base", "cands"), rounds, seeds, confidence)
    loose = F.coalesce(F.exists("cands", lambda c: ~c["seed"]), F.lit(False))
    known = read.where(~loose).select("doc", F.col("base").alias("spans"))
    open_ = read.where(loose).select("doc", "id", "mark", "base")
    met = open_.join(new, F.col("id").eqNullSafe(F.col("new_id")) & (F.col("mark") == F.col("new_mark")), "left")
    rows = known.unionByName(met.select("doc", _all_spans().alias("spans")))
    clean = rows.select("doc", redacted(F.col("doc")[text_col], F.col("spans")).alias("clean"))
    return clean.select(*[F.col("clean").alias(c) if c == text_col else
                          F.length("clean").cast(docs.schema[c].dataType).alias(c) if c == length_col else
                          F.col("doc")[c].alias(c) for c in own])


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by its first kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    kind = "array<struct<start:bigint,end:bigint,kind:int>>"
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def merge(a, s):
        last = F.get(a, F.size(a) - 1)
        return F.when((F.size(a) > 0) & (s["start"] < last["end"]),
                      F.concat(F.slice(a, F.lit(1), F.size(a) - 1),
                               F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                                                last["kind"].alias("kind"))))
                      ).otherwise(F.concat(a, F.array(s))).cast(kind)

    def rebuild(d):
        # pieces are cut out of chunks: a cut never walks through the whole text
        def cut(start, end):
            a, b = F.floor(start / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int")
            low, high = start % CHUNK, (end - 1) % CHUNK + 1
            return (F.when(end <= start, F.lit(""))
                    .when(a == b, _substring(F.get(d["chunks"], a), low + 1, high - low))
                    .otherwise(F.concat(_substring(F.get(d["chunks"], a), low + 1, CHUNK),
                                        F.array_join(F.slice(d["chunks"], a + 2, b - a - 1), ""),
                                        _substring(F.get(d["chunks"], b), 1, high))))

        pieces = F.transform(d["spans"], lambda s, i: F.concat(
            cut(F.when(i > 0, F.get(d["spans"], i - 1)["end"]).otherwise(0), s["start"]), F.get(names, s["kind"])))
        tail = cut(F.get(d["spans"], F.size(d["spans"]) - 1)["end"], d["size"])
        return F.concat(F.array_join(pieces, ""), tail)

    data = F.array(F.struct(F.aggregate(by_start, F.array().cast(kind), merge).alias("spans"),
                            F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks"),
                            F.length(text).cast("bigint").alias("size")))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) <= 0, text).otherwise(F.get(F.transform(data, rebuild), F.lit(0)))
