"""Reachability over stored pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.markup import extract_hrefs
from ..functions.text import decode_entities
from ..functions.urls import (
    has_no_fragment,
    is_webpage,
    resolve_url,
    strip_trailing_slash,
    url_host,
    url_path,
)
from ..session import PAGE_BYTES, known_bytes, limit_batches, materialize, scratch_path
from .prefix import slash_prefixes
from .skew import lookup_join


#: Folders of stored links and pages at most, each of about so many bytes of links.
BUCKETS, BUCKET_BYTES = 63, 256 << 20
#: Folders of visited pages are merged above so many.
MERGE_TURNS = 32


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) for every anchor: resolved, entity-decoded, both without trailing slash."""
    limit_batches(pages.sparkSession, PAGE_BYTES)
    raw = pages.select(strip_trailing_slash(url).alias("src"), F.explode(extract_hrefs(html)).alias("href"))
    return raw.select("src", strip_trailing_slash(resolve_url("src", decode_entities("href"))).alias("dst"))


def crawl_candidates(links: DataFrame, bases: DataFrame) -> DataFrame:
    """(doc_set, base, src, dst): distinct links to pages that lie below the base of a doc set."""
    return links_below(links.filter(is_webpage("dst") & has_no_fragment("dst")), bases).distinct()


def links_below(links: DataFrame, bases: DataFrame) -> DataFrame:
    """(doc_set, base, src, dst): links of the same authority and below the path of a doc set's base.

    The base, as a slash-terminated prefix, is then one of the prefixes of the link, so bases and links meet in an equi join.
    """
    place = F.concat(F.lit("//"), url_host("dst"), url_path("dst"))
    offered = links.select("src", "dst", F.explode(slash_prefixes(place)).alias("below"))
    root = F.concat(F.lit("//"), url_host("base"), strip_trailing_slash(url_path("base")), F.lit("/"))
    rooted = bases.select("doc_set", "base", root.alias("below"))
    return lookup_join(offered, rooted, "below", "inner").select("doc_set", "base", "src", "dst")


def _bucket(url: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64("doc_set", url), F.lit(buckets)).cast("int")


def _observed_write(df: DataFrame, path: str, buckets: int) -> int:
    """Write rows in folders ``at``; the bits of the folders that got rows."""
    seen = Observation()
    bits = F.bit_or(F.expr("shiftleft(1L, at)"))
    rows = df.repartition(buckets, "at") if buckets > 1 else df  # one task per folder, so that a folder gets one file
    rows.observe(seen, F.coalesce(bits, F.lit(0).cast("bigint")).alias("bits")).write.partitionBy("at").parquet(path)
    return seen.get["bits"]


def reachable(candidates: DataFrame, bases: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_set, url): candidate links found from each base; all doc sets advance in one loop.

    Links and visited pages are stored once, in up to ``BUCKETS`` folders by a hash of (doc set, page), as many as their size
    asks for. A frontier of newly found pages meets only the folders of links its pages fall into, and new pages are checked
    against the folders of visited pages they fall into. So a round reads less as the frontier shrinks, and writes
    only its new pages; which folders have them is observed during the write. Folders of old rounds are merged
    now and then. A linked page that is not stored is found but leads nowhere.
    """
    spark = candidates.sparkSession
    place = scratch_path(spark, "crawl")
    stored = materialize(candidates.select("doc_set", "src", "dst"), "links")
    buckets = max(1, min(BUCKETS, known_bytes(stored) // bucket_bytes))
    stored = stored.withColumn("at", _bucket("src", buckets))
    if buckets > 1:
        # a page with very many links is spread over several files of its folder
        stored.repartition("at", F.pmod(F.xxhash64("dst"), F.lit(8))).write.partitionBy("at").parquet(f"{place}/links")
        stored = spark.read.schema("doc_set string, src string, dst string, at int").parquet(f"{place}/links")

    def pages(folders: list[str], bits: int = -1) -> DataFrame:
        found = spark.read.schema("doc_set string, url string, hop int, turn string, at int").option("basePath", f"{place}/pages").parquet(*folders)
        return found if bits == -1 or buckets == 1 else found.filter(F.col("at").isin([b for b in range(BUCKETS) if bits >> b & 1]))

    start = bases.select("doc_set", strip_trailing_slash("base").alias("url"), F.lit(0).alias("hop")).distinct()
    folders, hop = [f"{place}/pages/turn=0"], 0
    used = _observed_write(start.withColumn("at", _bucket("url", buckets)), folders[0], buckets)
    while used:
        frontier = pages(folders[-1:]).select("doc_set", F.col("url").alias("src"))
        links = stored.filter(F.col("at").isin([b for b in range(BUCKETS) if used >> b & 1])) if buckets > 1 else stored
        hop += 1
        reached = lookup_join(links, frontier, ["doc_set", "src"], "inner")
        reached = reached.select("doc_set", F.col("dst").alias("url")).distinct().withColumn("at", _bucket("url", buckets))
        near = -1
        if buckets > 1:  # only the folders of these pages are read for the comparison
            near = _observed_write(reached, f"{place}/reached/turn={hop}", buckets)
            reached = spark.read.schema("doc_set string, url string, at int").parquet(f"{place}/reached/turn={hop}")
        new = reached.join(pages(folders, near).select("doc_set", "url"), ["doc_set", "url"], "left_anti")
        folders.append(f"{place}/pages/turn={hop}")
        used = _observed_write(new.withColumn("hop", F.lit(hop)).select("doc_set", "url", "hop", "at"), folders[-1], buckets)
        if len(folders) > MERGE_TURNS:
            merged = f"{place}/pages/turn=upto-{hop - 1}"
            _observed_write(pages(folders[:-1]).drop("turn"), merged, buckets)
            folders = [merged, folders[-1]]
    urls = pages(folders).filter("hop > 0").select("doc_set", "url")
    # the base string itself is no result; the same page in another spelling is
    return urls.join(bases.select("doc_set", F.col("base").alias("url")), ["doc_set", "url"], "left_anti")


def pages_per_set(found: DataFrame) -> DataFrame:
    return found.groupBy("doc_set").agg(F.count("*").alias("n_pages"))
