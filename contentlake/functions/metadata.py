"""Front matter: locating, parsing and rewriting.

The canonical form is ``MAP<STRING,STRING>`` with JSON-encoded values, so one type
holds scalars, lists and dates of any document.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

from .common import bind, col, lstrip_ws, strip_ws
from .text import ensure_period

# Keys that are dropped, the allowed types, and renamed types.
DROPPED_KEYS = [
    "_build", "aliases", "display_breadcrumb", "linkTitle", "menu", "catalog",
    "catalogType", "journeys", "tags", "authors", "date", "versions",
]
ALLOWED_TYPES = ["tutorial", "how-to", "concept", "reference", "getting-started", "redoc"]
RENAMED_TYPES = {"task": "how-to", "tasks": "how-to", "concepts": "concept"}
MERGED_KEYS = ["categories", "doctypes"]

# Audit flags.
NO_METADATA = "No metadata found"
BAD_METADATA = "Error in frontmatter"


def split_front_matter(content: Column | str, mode: str) -> dict[str, Column]:
    """``before``, ``yaml`` and ``body`` of a document; ``yaml`` is NULL when there is no block.

    * ``lines``  - starts with ``---``; runs to the next line starting ``---`` or to the end
    * ``strict`` - starts with ``---``; cut at the first two ``---`` wherever they are
    * ``loose``  - cut at the first two ``---``; text may come before
    """
    content = col(content)
    if mode == "lines":
        block = F.regexp_extract(content, r"(?msd)\A---[^\n]*(?:\n|\z)(.*?)(?:^---.*)?\z", 1)
        return {"before": F.lit(""), "yaml": F.when(content.startswith("---"), block), "body": F.lit(None).cast("string")}
    parts = F.split(content, "---", 3)
    found = F.size(parts) == 3
    if mode == "strict":
        found = found & content.startswith("---")
    elif mode != "loose":
        raise ValueError(f"unknown mode {mode!r}")
    return {name: F.when(found, parts[i]) for i, name in enumerate(["before", "yaml", "body"])}


def _parse_udf():
    @F.pandas_udf("struct<kind:string,data:map<string,string>,error:string>")
    def parse(blocks: pd.Series) -> pd.DataFrame:
        import datetime
        import json

        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

        def text(value):
            if isinstance(value, datetime.datetime):
                return str(value.replace(tzinfo=None))
            return str(value)

        def named(value, above=()):
            """Keys of inner mappings as text; a value that holds itself is an error."""
            if not isinstance(value, (dict, list, tuple, set)):
                return value
            if id(value) in above:
                raise ValueError("Circular reference detected")
            above = (*above, id(value))
            if isinstance(value, dict):
                return {text(k): named(v, above) for k, v in value.items()}
            return [named(v, above) for v in value]

        def one(block):
            if block is None:
                return None, None, None
            try:
                data = yaml.load(block, Loader=loader)
                if not data:
                    return "empty", None, None
                if not isinstance(data, dict):
                    return "other", None, None
                encoded = {str(k): json.dumps(named(v), ensure_ascii=False, default=text) for k, v in data.items()}
            except yaml.YAMLError:
                return "error", None, None
            except Exception as problem:  # whatever a block does, it concerns its own document only
                return "error", None, str(problem)
            return "map", encoded, None

        rows = [one(b) for b in blocks]
        return pd.DataFrame({name: [r[i] for r in rows] for i, name in enumerate(("kind", "data", "error"))})

    return parse


def parse_front_matter(yaml_text: Column | str) -> Column:
    """``STRUCT<kind, data, error>``: kind is map, empty, other (not a mapping), error, or NULL without a block.

    A malformed block only affects its own row; ``error`` holds the text of errors other than bad syntax.
    """
    return _parse_udf()(col(yaml_text))


def flat_front_matter(yaml_text: Column | str) -> Column:
    """Native map of a block holding only ``key: text`` lines (the last of repeated keys wins)."""
    lines = F.filter(F.split(col(yaml_text), "\n"), lambda line: line.rlike(r"\A[^\s:#][^:]*:(?: |\z)"))
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.regexp_extract(line, r"\A([^:]*?)\s*:", 1).alias("k"), F.trim(F.regexp_replace(line, r"\A[^:]*:", "")).alias("v")
        ),
    )

    def last_of_each(all_pairs: Column) -> Column:
        later = lambda i: F.slice(all_pairs["k"], i + 2, F.size(all_pairs))
        return F.map_from_entries(F.filter(all_pairs, lambda e, i: ~F.array_contains(later(i), e["k"])))

    return bind(pairs, last_of_each)


def text_value(data: Column, key: str) -> Column:
    """A value as text: strings without JSON quotes, other values as written."""
    raw = F.try_element_at(data, F.lit(key))
    return json_text(raw)


def json_text(raw: Column) -> Column:
    """Unquote a JSON string; any other JSON value stays as it is; ``null`` becomes NULL."""
    return F.when(raw.startswith('"'), F.from_json(F.concat(F.lit('{"v":'), raw, F.lit("}")), "v string")["v"]).when(
        raw != "null", raw
    )


def list_value(data: Column, key: str) -> Column:
    """The strings of a list, a string as a list of one, anything else as an empty list."""
    raw = F.try_element_at(data, F.lit(key))
    items = F.from_json(F.concat(F.lit('{"v":'), raw, F.lit("}")), "v array<variant>")["v"]
    strings = F.filter(items, lambda v: F.schema_of_variant(v) == "STRING")
    empty = F.array().cast("array<string>")
    return (
        F.when(raw.startswith("["), F.coalesce(F.transform(strings, lambda v: v.cast("string")), empty))
        .when(raw.startswith('"'), F.array(text_value(data, key)))
        .otherwise(empty)
    )


def has_value(data: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(data, F.lit(key)) != "null", F.lit(False))


def merge_types(data: Column) -> Column:
    """Categories then doctypes, renamed; NULL when the document has neither."""
    both = F.concat(*[list_value(data, key) for key in MERGED_KEYS])

    def rename(item: Column) -> Column:
        out = F.when(F.lit(False), item)
        for old, new in RENAMED_TYPES.items():
            out = out.when(item == old, new)
        return out.otherwise(item)

    present = has_value(data, MERGED_KEYS[0]) | has_value(data, MERGED_KEYS[1])
    return F.when(present, F.transform(both, rename))


def filter_types(types: Column) -> tuple[Column, Column]:
    """(allowed items in order with repeats, distinct removed items sorted)."""
    allowed = F.array(*[F.lit(t) for t in ALLOWED_TYPES])
    kept = F.filter(types, lambda t: t.isin(ALLOWED_TYPES))
    removed = F.array_sort(F.array_except(F.filter(types, lambda t: t.isNotNull()), allowed))
    return kept, removed


def drop_keys(data: Column, keys: list[str] | None = None) -> tuple[Column, Column]:
    """(map without the keys, removed keys in list order)."""
    keys = DROPPED_KEYS if keys is None else keys
    kept = F.map_filter(data, lambda k, _: ~k.isin(keys))
    removed = F.array_intersect(F.array(*[F.lit(k) for k in keys]), F.map_keys(data))
    return kept, removed


def _render_udf(dropped: list[str]):
    @F.pandas_udf("string")
    def render(blocks: pd.Series, types: pd.Series, descriptions: pd.Series) -> pd.Series:
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        dumper = getattr(yaml, "CSafeDumper", yaml.SafeDumper)

        def one(block, type_list, description):
            if block is None:
                return None
            try:
                data = yaml.load(block, Loader=loader)
            except Exception:  # reported by parse_front_matter
                return None
            out = {k: v for k, v in data.items() if k not in dropped}
            if type_list is not None:
                out["type"] = list(type_list)
            if description is not None:
                out["description"] = description
            return yaml.dump(out, Dumper=dumper, sort_keys=False, allow_unicode=True).strip()

        return pd.Series([one(*row) for row in zip(blocks, types, descriptions)], dtype=object)

    return render


def render_front_matter(yaml_text: Column, types: Column, description: Column) -> Column:
    """YAML of the block with dropped and merged keys gone and the given values put in.

    Values the rules do not touch come from the original block, so dates stay dates.
    """
    return _render_udf(DROPPED_KEYS + MERGED_KEYS)(yaml_text, types, description)


def description_with_period(data: Column) -> Column:
    """The fixed description; NULL unless the value is a string."""
    raw = F.try_element_at(data, F.lit("description"))
    return F.when(raw.startswith('"'), ensure_period(text_value(data, "description")))


def assemble_document(before: Column, yaml_text: Column, body: Column) -> Column:
    return F.concat(before, F.lit("---\n"), yaml_text, F.lit("\n---\n\n"), lstrip_ws(body))


def doc_id(data: Column) -> Column:
    """Document id, or the text ``null`` when it is missing or blank."""
    value = text_value(data, "docs")
    return F.when(strip_ws(value) != "", value).otherwise("null")


def audited_block(content: Column | str) -> Column:
    """The block to parse for an audit: NULL without a leading ``---``, malformed text when it never closes."""
    content = col(content)
    block = split_front_matter(content, "strict")["yaml"]
    return F.when(content.startswith("---"), F.coalesce(block, F.lit("[")))


def audit_status(kind: Column, unreadable: Column | None = None) -> Column:
    """``ok`` or one of the two audit flags, from the parse result of :func:`audited_block`.

    A document that could not be read (``unreadable``) is an error, whatever its content says.

    The status needs nothing but the parse result, so no document text has to wait while
    its block is parsed.
    """
    return (
        F.when(F.lit(False) if unreadable is None else unreadable, BAD_METADATA)
        .when(kind.isNull() | (kind == "empty"), NO_METADATA)
        .when(kind.isin("error", "other"), BAD_METADATA)
        .otherwise("ok")
    )
