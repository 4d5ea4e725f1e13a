"""Sinks: partitioned offers store, published bundle rows, artifacts, lines, CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerboard.functions.prices import PRICE_TYPE
from offerboard.functions.text import run_order


def write_offers(offers: DataFrame, path: str, fmt: str = "parquet",
                 partition_cols=("location", "file_week")) -> None:
    """One partition per location and week; a rewritten week replaces only itself.

    Dynamic partition overwrite keeps every partition the batch does not touch.
    Rows are clustered by the partition columns with a ``rebalance`` hint: AQE
    then splits a hot (location, week) over several tasks (several files in
    its folder) and merges small ones, so no task writes a third of the data.
    """
    cols = list(partition_cols)
    (offers.hint("rebalance", *cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).format(fmt).save(path))


def meal_lists(offers: DataFrame, keys=("location", "offer_key"), pos="pos",
               desc="desc", price="price") -> DataFrame:
    """Long rows -> one ordered meal list per key; empty days give ``[]``.

    The list is built with a partial (map-side) collect and ordered by ``pos``
    afterwards. It is meant for keys whose lists are bounded (a menu day or
    week); see ``offerboard.operators.menus.nest_offers`` for chunked lists.
    """
    meal = F.struct(F.col(pos).alias("pos"), F.col(desc).alias("desc"), F.col(price).cast(PRICE_TYPE).alias("price"))
    return (offers.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.when(F.col(pos).isNotNull(), meal))).alias("_m"))
            .select(*keys, F.transform("_m", lambda m: F.struct(m["desc"].alias("desc"), m["price"].alias("price")))
                    .alias("meals")))


def publish_bundle(offers: DataFrame, locations: DataFrame, location_key: str = "location",
                   keys=None) -> DataFrame:
    """One published record per location: (name, link, details, offers MAP<key, meals>), as JSON too.

    The bundle document is the sequence of these rows (``{"locations": [...]}``
    is only the envelope a writer puts around them), so no single task ever
    holds all locations. A location without offers gets ``{}``. ``keys`` (a
    Column predicate on ``offer_key``, e.g. the weeks the page can show)
    bounds each record to a window of keys; without it a record holds the
    location's whole archive.
    """
    if keys is not None:
        offers = offers.filter(keys)
    lists = meal_lists(offers, keys=(location_key, "offer_key"))
    per_loc = lists.groupBy(location_key).agg(
        F.map_from_entries(F.collect_list(F.struct("offer_key", "meals"))).alias("offers"))
    empty = F.create_map().cast("map<string,array<struct<desc:string,price:decimal(10,2)>>>")
    out = (locations.join(per_loc, location_key, "left")
           .select(location_key, "name", "link", "details", F.coalesce("offers", empty).alias("offers")))
    return out.withColumn("json", F.to_json(F.struct("name", "link", "details", "offers")))


def write_artifacts(artifacts: DataFrame, path: str, run: str = "0") -> None:
    """Rows (artifact_name, kind, body) -> parquet partitioned by kind and run (never one local file per row).

    A repeated run replaces its own partitions; ``latest_artifacts`` reads the
    newest body of each name.
    """
    (artifacts.select("artifact_name", "body", "kind", F.lit(run).alias("run")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("kind", "run").parquet(path))


def latest_artifacts(artifacts: DataFrame) -> DataFrame:
    """(artifact_name, kind, body): of stored artifacts, the body of each name's latest run."""
    return artifacts.groupBy("artifact_name", "kind").agg(
        F.max_by("body", run_order(F.col("run").cast("string"))).alias("body"))


def document_text(lines: DataFrame, key: str = "doc_id", pos: str = "pos", line: str = "line",
                  first_only: bool = False) -> DataFrame:
    """Ordered lines -> one text per document; ``first_only`` keeps line 0 only."""
    if first_only:
        return (lines.groupBy(key).agg(F.min_by(line, pos).alias("text")))
    return (lines.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(line).alias("l")))).alias("_l"))
            .select(key, F.array_join(F.transform("_l", lambda x: x["l"]), "\n").alias("text")))


def lines_sink(lines: DataFrame, path: str, key: str = "doc_id", pos: str = "pos", line: str = "line",
               first_only: bool = False, fmt: str = "json") -> None:
    """Write each document's ordered lines as one record (key, text).

    JSON lines keep multi-line texts apart; ``fmt='text'`` writes the bare
    texts one after another, as a plain text file would hold them.
    """
    out = document_text(lines, key, pos, line, first_only)
    if fmt == "text":
        out.select("text").write.mode("overwrite").text(path)
    else:
        out.write.mode("overwrite").format(fmt).save(path)


def csv_sink(df: DataFrame, path: str, header: bool = False) -> None:
    """CSV as ``scan_csv_table`` reads it: quotes doubled, blanks at a cell's ends and line breaks kept."""
    (df.write.mode("overwrite").option("header", header).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
