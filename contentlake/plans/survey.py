"""Survey cleaning and the feedback dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import scrub_emails
from ..functions.urls import absolute_url, replace_literal, strip_vars
from ..operators.aggregates import MAX_COMMENTS, UNKNOWN_PRODUCT, feedback_by_page, metadata_row_dropped
from ..operators.enrich import attach_country, missing_keys, nearest_place, upsert_cache
from ..operators.filters import drop_keyword, drop_missing, exclude_ids
from ..operators.prefix import canonical_links, dedup_rules, match_prefix
from ..session import cut_hot_partitions

# The word that marks trial answers.
TRIAL_WORD = "testing"


# The headers of survey files, in any case, and the names the steps use.
SURVEY_COLUMNS = {
    "link url": "link_url", "current url": "current_url", "q1": "q1", "q2": "q2", "startdate": "start_date",
    "start date": "start_date", "responseid": "response_id", "response_id": "response_id", "response id": "response_id",
    "locationlatitude": "lat", "locationlongitude": "lon", "canonical link url": "canonical_url",
}


def survey_columns(df: DataFrame) -> DataFrame:
    """Columns of a survey file under the names the steps use; other columns stay.

    A file without any known column is an error that lists what was looked for. Of two headers for
    one name the first counts.
    """
    taken = {c for c in df.columns if c in SURVEY_COLUMNS.values()}
    renamed = {}
    for c in df.columns:
        name = SURVEY_COLUMNS.get(c.strip().lower())
        if name and name not in taken and c not in taken:
            renamed[c] = name
            taken.add(name)
    if not taken:
        raise ValueError(f"no survey column found among {df.columns}; looked for {sorted(SURVEY_COLUMNS)}")
    return df.withColumnsRenamed(renamed)


def with_first_prefix(df: DataFrame, value: str, rules: DataFrame) -> DataFrame:
    """Adds (matched, target) of the first rule by (ord, prefix)."""
    return match_prefix(df, value, rules, pick="first")


def map_product(df: DataFrame, url: str, rules: DataFrame, out: str = "product") -> DataFrame:
    """Product of the first matching prefix, or the unmapped marker."""
    mapped = with_first_prefix(df, url, rules)
    return mapped.withColumn(out, F.coalesce("target", F.lit(UNKNOWN_PRODUCT))).drop("matched", "target")


def clean_link_urls(df: DataFrame, names: list[str], origin: str) -> DataFrame:
    """Absolute, normal URLs without server variables; originals stay in ``original_<name>``."""
    present = [n for n in names if n in df.columns]
    originals = {f"original_{n}": F.col(n) for n in present if f"original_{n}" not in df.columns}
    absolute = df.withColumns(originals).withColumns({n: absolute_url(n, origin) for n in present})
    return absolute.withColumns({n: strip_vars(n, origin) for n in present})


def clean_survey(
    df: DataFrame,
    *,
    origin: str,
    rules: DataFrame | None = None,
    exclude: DataFrame | None = None,
    replacements: list[tuple[str, str]] = (),
    cache: DataFrame | None = None,
    places: DataFrame | None = None,
) -> DataFrame:
    """All cleaning steps in order; a step whose column is absent does nothing.

    Takes the columns of a survey file (:func:`survey_columns`) or link_url, current_url, q2,
    response_id, lat, lon as available. ``canonical_url`` is added wherever there is a link: without rules it equals the normalised URL.
    """
    cut_hot_partitions(df.sparkSession)
    df = survey_columns(df)
    df = drop_missing(df, "link_url")
    df = drop_keyword(df, "q2", TRIAL_WORD)
    if rules is None:
        df = clean_link_urls(df, ["link_url", "current_url"], origin)
    else:
        df = clean_link_urls(df, ["current_url"], origin)
    if "link_url" in df.columns:
        if rules is None:
            df = df.withColumn("canonical_url", F.col("link_url"))
        else:
            if "original_link_url" not in df.columns:
                df = df.withColumn("original_link_url", F.col("link_url"))
            df = canonical_links(df, "link_url", dedup_rules(rules), origin, "canonical_url")
        url: Column = F.col("canonical_url")
        for old, new in replacements:
            url = replace_literal(url, old, new)
        df = df.withColumn("link_url", url)
    if exclude is not None:
        df = exclude_ids(df, exclude, "response_id")
    if "q2" in df.columns:
        df = df.withColumn("q2", scrub_emails("q2")[0])
    if cache is not None and {"lat", "lon"} <= set(df.columns):
        if places is not None:
            found = nearest_place(missing_keys(df, cache, "lat", "lon"), places)
            cache = upsert_cache(cache, found, ["lat_key", "lon_key"])
        df = attach_country(df, cache, "lat", "lon")
    return df


def feedback_dataset(
    df: DataFrame, products: DataFrame, *, url: str = "link_url", order: str | list[str] = "row_id", max_comments: int = MAX_COMMENTS
) -> DataFrame:
    """Feedback per canonical page and product. ``order``: row_id, or file and row_order of a survey file."""
    cut_hot_partitions(df.sparkSession)
    mapped = map_product(survey_columns(df), url, products)
    return feedback_by_page(
        mapped,
        url=url,
        rating="q1",
        comment="q2",
        date="start_date",
        order=order,
        product=F.col("product"),
        max_comments=max_comments,
    )


def survey_export_cleanup(df: DataFrame, order: str, columns: list[str], marker: str) -> DataFrame:
    return metadata_row_dropped(df, order, columns, marker).select(order, *columns)
