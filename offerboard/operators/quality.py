"""Quality checks and comparisons (section F)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerboard.functions.dates import week_label, weekday_index
from offerboard.functions.prices import normalize_price as _normalize


def normalize_price(df: DataFrame, raw: str = "price_raw") -> DataFrame:
    """price DECIMAL(10,2) and price_status (ok, zero, missing, invalid)."""
    price, status = _normalize(F.col(raw))
    return df.withColumn("price", price).withColumn("price_status", status)


def check_keys(offers: DataFrame, key: str = "offer_key", file_week: str | None = "file_week") -> DataFrame:
    """per offer key: kind, weekend day, impossible ISO week, key outside the file's week."""
    k = F.col(key)
    day = F.when(k.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(k, "yyyy-MM-dd"))
    is_week = k.rlike(r"^[0-9]{4}-W[0-9]{2}$")
    wy = F.regexp_extract(k, r"^([0-9]{4})-W", 1).try_cast("int")
    wn = F.regexp_extract(k, r"-W([0-9]{2})$", 1).try_cast("int")
    # an ISO year has week 53 exactly when its 28 December is in week 53
    weeks_in_year = F.weekofyear(F.make_date(wy, F.lit(12), F.lit(28)))
    out = (offers.withColumn("key_kind", F.when(day.isNotNull(), F.lit("day")).when(is_week, F.lit("week"))
                             .otherwise(F.lit("other")))
           .withColumn("is_weekend", F.coalesce(weekday_index(day) >= 5, F.lit(False)))
           .withColumn("bad_week", F.when(is_week, (wn < 1) | (wn > weeks_in_year)).otherwise(F.lit(False)))
           .withColumn("key_week", F.when(day.isNotNull(), week_label(day, "iso")).when(is_week, k)))
    if file_week and file_week in offers.columns:
        fw = F.regexp_replace(F.col(file_week), r"^([0-9]{4})-W?([0-9]{2})$", "$1-W$2")
        out = out.withColumn("file_week_label", fw) \
            .withColumn("week_mismatch", F.coalesce(F.col("key_week") != fw, F.lit(False)))
    return out


def duplicate_meals(offers: DataFrame, keys=("location", "offer_key"), desc: str = "desc") -> DataFrame:
    """the same description more than once under one key -> (keys..., desc, n)."""
    return (offers.filter(F.col(desc).isNotNull()).groupBy(*keys, desc)
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def diff_runs(a: DataFrame, b: DataFrame, keys=("location", "offer_key", "pos"),
              values=("desc", "price")) -> DataFrame:
    """meals added, removed or changed between two extractions.

    A full outer equi-join on the keys with null-safe comparison of the
    values -> (keys..., status, a_<v>..., b_<v>...); unchanged rows are kept
    with status 'same'.
    """
    keys = list(keys)
    aa = a.select(*keys, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("_in_a"))
    bb = b.select(*keys, *[F.col(v).alias(f"b_{v}") for v in values], F.lit(True).alias("_in_b"))
    j = aa.join(bb, keys, "full_outer")
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}"))
    status = (F.when(F.col("_in_a").isNull(), F.lit("added")).when(F.col("_in_b").isNull(), F.lit("removed"))
              .when(same, F.lit("same")).otherwise(F.lit("changed")))
    return j.withColumn("status", status).drop("_in_a", "_in_b")


def diff_runs_set(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F4, set form: (rows only in a, rows only in b), duplicates counted."""
    return a.exceptAll(b), b.exceptAll(a)


def run_matrix(inputs: DataFrame, cases: list[dict]) -> DataFrame:
    """each input row under each case (variant).

    The cases are a short literal list from the caller; each row is repeated
    once per case by ``explode`` of a literal array, so there is no join.
    """
    fields = sorted({k for c in cases for k in c})
    arr = F.array(*[F.struct(*[F.lit(c.get(f)).cast("string").alias(f) for f in fields]) for c in cases])
    return inputs.withColumn("_case", F.explode(arr)).select("*", *[F.col(f"_case.{f}").alias(f) for f in fields]) \
        .drop("_case")


def usage_summary(usage: DataFrame, keys=("location", "provider", "model")) -> DataFrame:
    """token sums per key and whether every record's total = prompt + completion."""
    return usage.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.bool_and(F.coalesce(F.col("total_tokens") == F.col("prompt_tokens") + F.col("completion_tokens"),
                              F.lit(False))).alias("totals_ok"))
