"""Small expression helpers shared by the function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Unicode white space including the four separators U+001C..U+001F.
WS = r"[\s\x1c-\x1f]"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed(value: Column) -> Column:
    """A column that is computed right here and nowhere else (usable once per ``select``).

    Exploding a single value stops the optimizer from moving the expression upwards. So a later
    filter does not evaluate it a second time, and wide inputs do not travel through a Python stage.
    """
    return F.explode(F.array(value))


def strip_ws(c: Column | str) -> Column:
    """Trim all Unicode white space on both ends (plain ``trim`` removes spaces only)."""
    return F.trim(col(c), F.lit(WS_CHARS))


def rstrip_ws(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(WS_CHARS))


def lstrip_ws(c: Column | str) -> Column:
    return F.ltrim(col(c), F.lit(WS_CHARS))


def unify_newlines(c: Column | str) -> Column:
    """``\\r\\n`` and lone ``\\r`` become ``\\n``, as text-mode reading does."""
    return F.regexp_replace(col(c), r"\r\n?", "\n")


def head_and_tail(text: Column, marks: list[str]) -> Column:
    """``STRUCT<head, tail>``: the text up to the end of the line with the last of ``marks``, and the rest.

    The tail holds no mark, so a pattern whose matches need one (and end on its line) only has to search the head.
    A text without marks is all tail. Cut by bytes, which is far cheaper than a search by a pattern.
    """
    rest = text
    for mark in marks:
        rest = F.substring_index(rest, mark, -1)

    def measure(p: Column) -> Column:
        whole, after = F.octet_length(p["text"]), F.octet_length(p["rest"])
        line = F.octet_length(F.substring_index(p["rest"], "\n", 1)) + 1
        tail = F.when(whole == after, whole).otherwise(F.greatest(after - line, F.lit(0)))
        return F.struct(p["text"].cast("binary").alias("bytes"), (whole - tail).alias("n"), tail.alias("tail"))

    def cut(p: Column) -> Column:
        return F.struct(
            p["bytes"].substr(F.lit(1), p["n"]).cast("string").alias("head"),
            p["bytes"].substr(p["n"] + 1, p["tail"]).cast("string").alias("tail"),
        )

    return bind(bind(F.struct(text.alias("text"), rest.alias("rest")), measure), cut)


def replace_matches(text: Column, pattern: str, groups: list[int], build: Callable[..., Column]) -> Column:
    """Replace every match of ``pattern`` by ``build(group, ...)``, a computed column.

    The text is cut at the matches once; groups are then taken out of the short matches.
    """
    cut = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )

    def rebuild(c: Column) -> Column:
        pieces = F.transform(
            c["hits"],
            lambda hit, i: F.concat(F.get(c["gaps"], i), build(*[F.regexp_extract(hit, pattern, g) for g in groups])),
        )
        return F.concat(F.array_join(pieces, ""), F.element_at(c["gaps"], -1))

    return bind(cut, rebuild)
