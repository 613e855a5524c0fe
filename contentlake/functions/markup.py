"""Extraction from HTML, XML and shortcodes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

from .common import col, replace_matches
from .html import anchor_hrefs
from .text import clean_text

# Shortcode and element patterns.
INCLUDE = r"""(?U)\{\{<[\s&&[^\n]]*include[\s&&[^\n]]*["']([^"'\n]+)["'][\s&&[^\n]]*>\}\}"""
INCLUDE_QUOTED = r'(?U)\{\{<[\s&&[^\n]]*include[\s&&[^\n]]*"([^"\n]+)"[\s&&[^\n]]*>\}\}'
RELREF = r"""(?U)\{\{<\s*relref\s*["']([^"']+)["']\s*>\}\}"""
SHORTCODE_END = ">}}"
# A quoted value may hold ``>``; the bound on the pieces of a tag keeps the matcher's stack small.
XML_TITLE = r"""(?U)<(?:article|module)(?:[^>"'\s]++|\s(?!name=)|"[^"]*+"|'[^']*+'){0,500}+\sname=["']([^"']+)["']"""


def include_refs(text: Column | str, double_quotes_only: bool = False) -> Column:
    """Paths named by include shortcodes, in order."""
    return F.regexp_extract_all(col(text), F.lit(INCLUDE_QUOTED if double_quotes_only else INCLUDE), F.lit(1))


def include_gaps(text: Column | str) -> Column:
    """The text between include shortcodes: one more piece than there are shortcodes."""
    return F.split(col(text), INCLUDE, -1)


def include_key(ref: Column) -> Column:
    return F.regexp_replace(ref, r"\A/+", "")


def extract_hrefs(html: Column | str) -> Column:
    """Raw ``href`` values of anchors in order, found by the tokenizer of :mod:`.html`."""
    return anchor_hrefs(html)


def _element_name_udf():
    @F.pandas_udf("string")
    def element_name(docs: pd.Series) -> pd.Series:
        import xml.etree.ElementTree as ET

        def one(doc):
            if doc is None:
                return None
            try:
                root = ET.fromstring(doc)
            except (ET.ParseError, ValueError):
                return None
            names = (
                el.attrib.get("name", "").strip()
                for el in root.iter()
                if isinstance(el.tag, str) and el.tag.rpartition("}")[2] in ("article", "module")
            )
            return next((n for n in names if n), None)

        return pd.Series([one(d) for d in docs], dtype=object)

    return element_name


def xml_title(xml: Column | str) -> Column:
    """Name of the first article or module; a text search stands in for documents that do not parse.

    ``xpath_string`` is no option: one malformed document would fail the whole job.
    """
    xml = col(xml)
    searched = F.nullif(F.regexp_extract(xml, XML_TITLE, 1), F.lit(""))
    return F.coalesce(clean_text(F.coalesce(_element_name_udf()(xml), searched)), F.lit(""))


def _segments(path: Column) -> Column:
    """Path segments with ``.``, ``..`` and empty ones resolved; leading ``..`` stay."""
    return F.aggregate(
        F.filter(F.split(path, "/"), lambda s: ~s.isin("", ".")),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            (s == "..") & (F.size(acc) > 0) & (F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("..")) != ".."),
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
        ).otherwise(F.concat(acc, F.array(s))),
    )


def relative_link(target: Column, folder: Column) -> Column:
    """Path that leads from ``folder`` to ``target``, both relative to the same root."""
    pair = F.struct(_segments(target).alias("t"), _segments(folder).alias("f"))

    def join(p: Column) -> Column:
        t, f = p["t"], p["f"]
        shorter = F.least(F.size(t), F.size(f))
        differing = F.filter(F.sequence(F.lit(1), shorter + 1), lambda i: ~F.get(t, i - 1).eqNullSafe(F.get(f, i - 1)) | (i > shorter))
        common = F.element_at(differing, 1) - 1
        ups = F.array_repeat(F.lit(".."), F.size(f) - common)
        rest = F.slice(t, common + 1, F.size(t))
        link = F.array_join(F.concat(ups, rest), "/")
        return F.when(link == "", ".").otherwise(link)

    return F.element_at(F.transform(F.array(pair), join), 1)


def relref_to_relative(text: Column | str, folder: Column | str, doc_set: Column | str) -> Column:
    """Each relref shortcode becomes the relative path from the document's folder."""
    folder = col(folder)
    prefix = F.concat(F.lit("/"), col(doc_set), F.lit("/"))

    def build(target: Column) -> Column:
        below = F.when(target.startswith(prefix), target.substr(F.length(prefix) + 1, F.length(target))).otherwise(
            F.regexp_replace(target, r"\A/", "")
        )
        return relative_link(below, folder)

    return replace_matches(col(text), RELREF, [1], build)
