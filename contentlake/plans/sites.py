"""Inventories of web sites and XML document trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.markup import xml_title
from ..functions.urls import xml_public_link
from ..operators.enrich import last_commit
from ..operators.graph import crawl_candidates, page_links, reachable
from ..sources.doctree import select_languages
from ..sources.tables import section_label

# Languages of the XML tree.
LANGUAGES = ["cn", "en", "he", "it", "ja", "ru", "tr"]


def site_inventory(pages: DataFrame, bases: DataFrame) -> DataFrame:
    """(doc_set, section, url): pages found below the base of every doc set."""
    found = reachable(crawl_candidates(page_links(pages), bases), bases)
    return found.select("doc_set", section_label(F.col("doc_set")).alias("section"), "url")


def xml_inventory(docs: DataFrame, commits: DataFrame, site: str, languages: list[str] | None = None) -> DataFrame:
    """(lang, file, title, link, last_commit) of the documents in the listed languages.

    ``commits`` holds (path, commit_ts).
    """
    picked = select_languages(docs, languages or LANGUAGES)
    titled = picked.select(
        "lang", F.col("path").alias("file"), xml_title("xml").alias("title"), xml_public_link("path", site).alias("link")
    )
    return last_commit(titled, commits.withColumnRenamed("path", "file"), "file", "commit_ts")
