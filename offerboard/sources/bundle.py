"""A5 as a stream: the published document in lines, cut per location and key, written as valid JSON by parts.

The page loads one document, ``{"locations": [{name, link, details, offers:
{key: [meals]}}, ...]}``. Its lines are rows here, each at most ``max_items``
meals long, range-partitioned and sorted into the document's order; the part
files, one after another, are the document. No row, task or driver holds a
location's archive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerboard.functions.prices import PRICE_TYPE

ORDER = ["section", "location", "kind", "offer_key", "part"]


def bundle_lines(offers: DataFrame, locations: DataFrame, max_items: int = 1000) -> DataFrame:
    """(section, location, kind, offer_key, part, value): the document's lines; sorted by these columns they are it.

    Meals come in the order of their positions, ``max_items`` positions a line;
    an empty day (NULL position) is an empty list, a location without offers
    an empty object. Offers of unknown locations are not published; rows
    without a key are no offers. Commas stand in front of all but the first
    entry, so no line needs the one after it.
    """
    known = locations.select("location", "name", "link", "details").where(F.col("location").isNotNull())
    rows = offers.where(F.col("offer_key").isNotNull()).join(known.select("location"), "location", "left_semi")
    meal = F.struct(F.col("pos").alias("pos"), F.col("desc").alias("desc"), F.col("price").cast(PRICE_TYPE).alias("price"))
    parts = rows.groupBy("location", "offer_key", F.coalesce(F.floor(F.col("pos") / max_items), F.lit(-1)).alias("part")) \
        .agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), meal))).alias("_m"))
    json = F.transform("_m", lambda m: F.to_json(F.struct(m["desc"].alias("desc"), m["price"].alias("price")), {"ignoreNullFields": "false"}))
    parts = parts.select("location", "offer_key", "part", F.array_join(json, ",").alias("meals"))
    # a day's empty row says nothing beside meals
    keys = parts.groupBy("location", "offer_key").agg(F.min(F.when(F.col("part") >= 0, F.col("part"))).alias("first"), F.max("part").alias("last"))
    opens = keys.groupBy("location").agg(F.min("offer_key").alias("first_key"))
    flagged = (parts.join(keys, ["location", "offer_key"]).where((F.col("part") >= 0) | F.col("first").isNull())
               .join(opens, "location"))
    begins = (F.col("part") == F.col("first")) | F.col("first").isNull()
    head = F.concat(F.when(F.col("offer_key") == F.col("first_key"), "").otherwise(","), F.to_json(F.array("offer_key")))
    key = F.concat(F.regexp_replace(head, r"^(,?)\[(.*)\]$", "$1$2"), F.lit(":["))
    body = flagged.select(
        F.lit(1).alias("section"), "location", F.lit(1).alias("kind"), "offer_key", F.col("part").cast("bigint").alias("part"),
        F.concat(F.when(begins, key).otherwise(","), F.col("meals"), F.when(F.col("part") == F.col("last"), "]").otherwise("")).alias("value"))
    first = known.agg(F.min("location").alias("first_location"))
    record = F.to_json(F.struct("name", "link", "details"), {"ignoreNullFields": "false"})
    edge = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    around = known.join(first, known["location"] == first["first_location"], "left").select("location", F.explode(F.array(
        edge(0, F.concat(F.when(F.col("first_location").isNull(), ",").otherwise(""), F.regexp_replace(record, r"\}$", ""), F.lit(',"offers":{'))),
        edge(2, F.lit("}}")))).alias("e")) \
        .select(F.lit(1).alias("section"), "location", "e.kind", F.lit(None).cast("string").alias("offer_key"),
                F.lit(None).cast("bigint").alias("part"), "e.value")
    frame = locations.sparkSession.range(2).select(
        (F.col("id") * 2).cast("int").alias("section"), F.lit(None).cast("string").alias("location"), F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("offer_key"), F.lit(None).cast("bigint").alias("part"),
        F.when(F.col("id") == 0, '{"locations":[').otherwise("]}").alias("value"))
    return body.unionByName(around).unionByName(frame)


def write_bundle(lines: DataFrame, path: str) -> None:
    """Write the lines in order: part files in the order of their names are the document."""
    lines.orderBy(*ORDER).select("value").write.mode("overwrite").text(path)
