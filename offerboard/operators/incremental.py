"""Incremental processing (section E): only new links, only changed pages, latest run wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def new_links(links: DataFrame, seen: DataFrame | None = None, url: str = "url") -> DataFrame:
    """Links whose url is not in ``seen``; with no state everything is new.

    A ``left_anti`` equi-join; Spark/AQE broadcasts the seen set only when its
    runtime size is under the broadcast threshold, else sort-merge.
    """
    if seen is None:
        return links
    return links.join(seen.select(F.col(url)).distinct(), url, "left_anti")


def parse_high_water(col) -> Column:
    """A stored high-water text (``...Z`` or ``...+00:00``) -> TIMESTAMP; NULL if unreadable."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
                      F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssX")),
                      F.try_to_timestamp(c))


def changed_pages(items: DataFrame, state: DataFrame | None, key: str = "location", ts: str = "modified",
                  high_water: str = "high_water") -> DataFrame:
    """Items newer than their key's stored high-water mark (no mark -> changed).

    Items with no readable time are never 'changed' (the reference stops on them).
    """
    if state is None:
        return items.filter(F.col(ts).isNotNull())
    st = state.select(key, F.col(high_water).alias("_hw"))
    return (items.join(st, key, "left")
            .filter(F.col(ts).isNotNull() & (F.col("_hw").isNull() | (F.col(ts) > F.col("_hw"))))
            .drop("_hw"))


def advance_state(batch: DataFrame, state: DataFrame | None, key: str = "location", ts: str = "modified",
                  high_water: str = "high_water") -> DataFrame:
    """New high-water mark per key = max(old mark, newest time in the batch).

    Both inputs reduce through partial aggregation; the state has one row per key.
    """
    newest = batch.groupBy(key).agg(F.max(ts).alias(high_water))
    if state is None:
        return newest
    return (newest.unionByName(state.select(key, high_water))
            .groupBy(key).agg(F.max(high_water).alias(high_water)))


def latest_per_week(offers: DataFrame, keys=("location", "file_week"), run: str = "run_ts") -> DataFrame:
    """For each (location, week) keep only the rows of the latest run.

    The latest run per key is a max aggregate (map-side combined, so a hot key
    costs one partial row per task), then a semi-join keeps that run's rows.
    """
    keys = list(keys)
    latest = offers.groupBy(*keys).agg(F.max(run).alias(run))
    return offers.join(latest, [*keys, run], "left_semi")


def changed_sites(pages: DataFrame, state: DataFrame | None, prop: str = "article:modified_time",
                  url: str = "url", html: str = "html") -> DataFrame:
    """E3 for pages: a site is processed again when its modified-time meta is newer than its stored mark.

    B21/B22 read and validate the meta value (a value not starting with a year
    never counts as changed); the location key is the page host. Output: the
    changed pages with ``location`` and ``modified``; feed them to
    ``advance_state`` after the run's writes succeed.
    """
    from offerboard.operators.links import host_of, page_meta
    meta = page_meta(pages, prop, html).withColumn("location", host_of(url)) \
        .withColumn("modified", F.col("meta_ts"))
    return changed_pages(meta, state, "location", "modified")
