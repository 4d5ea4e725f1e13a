"""Readers for the offers archive, location metadata, pages, CSV tables and usage records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Prices are read as text so that absent, null, "" and 0 stay distinguishable
# (see offerboard.functions.prices.normalize_price).
OFFERS_DOC_SCHEMA = "MAP<STRING, ARRAY<STRUCT<desc: STRING, price: STRING>>>"
LOCATION_SCHEMA = "name STRING, link STRING, offers MAP<STRING, ARRAY<STRUCT<desc: STRING, price: STRING>>>, details ARRAY<STRING>"
USAGE_SCHEMA = (
    "completion_tokens BIGINT, prompt_tokens BIGINT, total_tokens BIGINT, "
    "completion_tokens_details STRUCT<accepted_prediction_tokens: BIGINT, audio_tokens: BIGINT, "
    "reasoning_tokens: BIGINT, rejected_prediction_tokens: BIGINT>, "
    "prompt_tokens_details STRUCT<audio_tokens: BIGINT, cached_tokens: BIGINT>"
)


def _whole_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    # .format('text').load keeps wholetext=True; DataFrameReader.text() would
    # override the option with its own default and read lines.
    return (spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(path)
            .select(F.col("value"), F.col("_metadata.file_path").alias("file_path")))


def offers_document_rejects(files: DataFrame) -> DataFrame:
    """(file_path, reason) of offers documents that are not valid JSON of the archive's form."""
    bad = F.from_json("value", OFFERS_DOC_SCHEMA).isNull()
    return files.filter(bad).select("file_path", F.lit("not an offers document").alias("reason"))


def scan_offers_rejects(spark: SparkSession, path: str, glob: str = "[0-9]*.json") -> DataFrame:
    """A1: the archive's files that ``scan_offers`` cannot read."""
    return offers_document_rejects(_whole_files(spark, path, glob))


def folder_value(name: str, path: str = "file_path") -> Column:
    """The value of a ``<name>=<value>`` folder of a path; NULL without one."""
    found = F.regexp_extract(F.col(path), f"/{name}=([^/]+)/", 1)
    return F.nullif(F.nullif(F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))


def location_of(path: str = "file_path") -> Column:
    """A file's location: its ``location=`` folder, else its parent folder."""
    return F.coalesce(folder_value("location", path), F.regexp_extract(F.col(path), r"/([^/]+)/[^/]+$", 1))


def parse_offers_documents(files: DataFrame, keep_empty: bool = False) -> DataFrame:
    """(value, file_path) of offers documents -> one row per meal.

    Output: (location, file_week, run, offer_key, pos, desc, price_raw).
    Location is the parent folder. The file name is ``<week>.json``, or
    ``<week>@<run>.json`` for a later scrape of the same week (``run`` NULL
    otherwise). In an archive that Spark wrote, folders name all three:
    ``location=<l>/file_week=<w>/run=<r>/<any file>``. An empty day (``[]``) gives one row with NULL pos/desc/price_raw;
    an empty document (``{}``) gives no row, or with ``keep_empty`` one row
    with NULL offer_key, which tells a store that the week has been emptied.
    Files that are not valid JSON come out of ``offers_document_rejects``.
    """
    stem = F.regexp_extract("file_path", r"/([^/]+)\.[A-Za-z]+$", 1)
    week = folder_value("file_week")
    doc = files.select(
        location_of("file_path").alias("location"),
        F.coalesce(week, F.regexp_extract(stem, r"^([^@]*)", 1)).alias("file_week"),
        F.when(week.isNotNull(), folder_value("run")).otherwise(F.nullif(F.regexp_extract(stem, r"@(.*)$", 1), F.lit(""))).alias("run"),
        F.from_json("value", OFFERS_DOC_SCHEMA).alias("doc"),
    )
    explode = F.explode_outer if keep_empty else F.explode
    keys = doc.filter(F.col("doc").isNotNull()).select("location", "file_week", "run",
                                                       explode("doc").alias("offer_key", "meals"))
    meals = keys.select("location", "file_week", "run", "offer_key",
                        F.posexplode_outer("meals").alias("pos", "meal"))
    return meals.select(
        "location", "file_week", "run", "offer_key", F.col("pos").cast("bigint").alias("pos"),
        F.col("meal.desc").alias("desc"), F.col("meal.price").alias("price_raw"))


def scan_offers(spark: SparkSession, path: str, glob: str = "[0-9]*.json") -> DataFrame:
    """A1: the offers archive, one row per meal (see ``parse_offers_documents``)."""
    return parse_offers_documents(_whole_files(spark, path, glob))


def scan_locations(spark: SparkSession, path: str, glob: str = "details.json") -> DataFrame:
    """(location, name, link, details) from one metadata document per location folder."""
    return (spark.read.schema(LOCATION_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).json(path)
            .select(location_of("_metadata.file_path").alias("location"),
                    "name", "link", F.coalesce("details", F.array().cast("array<string>")).alias("details")))


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages table ``(page_id, url, html)``; fetching is outside this library."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def scan_usage(spark: SparkSession, path: str, glob: str = "*usage.json") -> DataFrame:
    """Usage records of both shapes; provider and model from the file name.

    ``<provider>_<model>_usage.json`` names both, ``usage.json`` or
    ``<tool>_usage.json`` name none / only the tool. Folders ``provider=``
    and ``model=`` of an archive that Spark wrote name them instead.
    """
    df = (spark.read.schema(USAGE_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True)
          .option("pathGlobFilter", glob).json(path))
    fp = F.col("_metadata.file_path")
    named = folder_value("provider", "_metadata.file_path")
    fname = F.regexp_extract(fp, r"/([^/]+)$", 1)
    stem = F.regexp_replace(fname, r"_?usage\.json$", "")
    provider = F.nullif(F.regexp_extract(stem, r"^([^_]+)_", 1), F.lit(""))
    model = F.nullif(F.regexp_extract(stem, r"^[^_]+_(.+)$", 1), F.lit(""))
    return df.select(
        location_of("_metadata.file_path").alias("location"),
        F.when(named.isNotNull(), named).otherwise(F.coalesce(provider, F.nullif(stem, F.lit("")))).alias("provider"),
        F.when(named.isNotNull(), folder_value("model", "_metadata.file_path")).otherwise(model).alias("model"),
        "prompt_tokens", "completion_tokens", "total_tokens",
        F.col("prompt_tokens_details.cached_tokens").alias("cached_tokens"),
        F.col("completion_tokens_details.reasoning_tokens").alias("reasoning_tokens"),
    )


def csv_records(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Records of CSV files -> (file, record, text): a quoted line break does not end a record.

    A line begins a record when an even number of quotes stands before it in
    its file. Files are read as lines, split like any text; each split counts
    its quotes on its own, for both states it may begin in, one small row a
    split carries state and number of records over the splits before it, and a
    join gives every line its record. So a file of any size is read by many
    tasks and its records are still numbered from 0. ``record`` counts blank
    lines too. A quote that never closes makes the rest of its file one record.
    """
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("line"), F.col("value")))
    in_split = Window.partitionBy("file", "split").orderBy("line")
    upto = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # parity of the quotes before a line within its split; a line begins a record if the split's own parity makes that even
    parity = F.coalesce(F.sum(quotes).over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("_odd", parity)
    lines = (lines.withColumn("_n0", F.sum((F.col("_odd") == 0).cast("long")).over(upto))
             .withColumn("_n1", F.sum(F.col("_odd")).over(upto)))
    splits = lines.groupBy("file", "split").agg(F.sum(quotes).alias("q"), F.max("_n0").alias("n0"), F.max("_n1").alias("n1"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    state = splits.withColumn("state", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2)
    first = state.select("file", "split", "state", F.coalesce(F.sum(F.when(F.col("state") == 0, F.col("n0")).otherwise(F.col("n1")))
                                                              .over(before), F.lit(0)).alias("first"))
    number = F.col("first") + F.when(F.col("state") == 0, F.col("_n0")).otherwise(F.col("_n1")) - 1
    parts = lines.join(first, ["file", "split"]).select("file", number.alias("record"), F.struct("split", "line", "value").alias("_l"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("_l")), lambda x: x["value"]), "\n")
    return parts.groupBy("file", "record").agg(text.alias("text")).select(
        "file", "record", F.regexp_replace("text", r"\r$", "").alias("text"))


def csv_cells(text) -> Column:
    """The cells of one CSV record as an array; quotes doubled within quotes stand for one.

    Splitting at the quotes leaves quoted parts at odd places. Commas outside
    them become a mark that no part holds, then the parts are joined and cut
    at the marks: linear in the record, without a pattern that backtracks.
    """
    mark, escape = "\u0001", "\u0002"
    guarded = F.replace(F.replace(text, F.lit(escape), F.lit(escape + "b")), F.lit(mark), F.lit(escape + "a"))
    parts = F.split(guarded, '"')
    # an empty part between two quoted ones is a doubled quote
    part = lambda p, i: (F.when(i % 2 == 1, p)
                         .when((p == "") & (i > 0) & (i < F.size(parts) - 1), F.lit('"'))
                         .otherwise(F.replace(p, F.lit(","), F.lit(mark))))
    cells = F.split(F.array_join(F.transform(parts, part), ""), mark)
    return F.transform(cells, lambda c: F.replace(F.replace(c, F.lit(escape + "a"), F.lit(mark)), F.lit(escape + "b"), F.lit(escape)))


def scan_csv_table(spark: SparkSession, path: str, skip_rows: list[int] | None = None, header: bool = True,
                   glob: str = "*.csv") -> DataFrame:
    """CSV tables -> (file, row, cells ARRAY<STRING>).

    ``row`` counts a file's records from 0 after the header; blank lines count
    but give no row, as do the rows of ``skip_rows`` (file records 5 and 6 of a
    table whose header is record 0 are rows 4 and 5). Quoted cells may hold
    commas, doubled quotes and line breaks (``csv_records``).
    ``csv_table_columns`` picks and names a column subset.
    """
    rows = csv_records(spark, path, glob).withColumn("row", F.col("record") - (1 if header else 0)) \
        .filter((F.col("row") >= 0) & (F.col("text") != ""))
    if skip_rows:
        rows = rows.filter(~F.col("row").isin(list(skip_rows)))
    return rows.select("file", "row", csv_cells(F.col("text")).alias("cells"))


def csv_table_columns(df: DataFrame, names: list[str], keep_cols: list[int] | None = None) -> DataFrame:
    """Turn the ``cells`` array of ``scan_csv_table`` into named columns."""
    idx = keep_cols if keep_cols is not None else list(range(len(names)))
    return df.select("file", "row", *[F.get(F.col("cells"), i).alias(n) for i, n in zip(idx, names)])
