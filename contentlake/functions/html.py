"""Tags of HTML documents by a character state machine, in Arrow batches.

The states are those of the HTML standard's tokenizer: text, tag name, attribute name, quoted and bare attribute values,
comments and declarations, and the raw text of elements such as ``script``. So ``>`` in a quoted value does not end a
tag, anchors inside comments, scripts, styles, titles and text areas are no anchors, and a tag that the document cuts off is none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, functions as F

from .common import col

# Elements whose content is text up to their own end tag, by the HTML standard.
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())

# What ends a state; everything before it is taken at once.
_BLANK = " \t\n\f\r"
_NAME_END = re.compile(r"[ \t\n\f\r/>]")
_ATTRIBUTE_END = re.compile(r"[ \t\n\f\r/>=]")
_BARE_END = re.compile(r"[ \t\n\f\r>]")
_FILLER = re.compile(r"[ \t\n\f\r/]*")
_SPACE = re.compile(r"[ \t\n\f\r]*")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.IGNORECASE) for name in RAW_TEXT}


def _attributes(html: str, at: int) -> tuple[dict[str, str], int] | None:
    """(attributes, place after the tag) from the end of a tag's name; None if the document ends inside the tag.

    The first of two attributes of one name counts.
    """
    found: dict[str, str] = {}
    n = len(html)
    while True:
        at = _FILLER.match(html, at).end()
        if at >= n:
            return None
        if html[at] == ">":
            return found, at + 1
        end = _ATTRIBUTE_END.search(html, at + 1)  # a leading = belongs to the name
        if not end:
            return None
        name, at = html[at : end.start()].lower(), _SPACE.match(html, end.start()).end()
        value = ""
        if at < n and html[at] == "=":
            at = _SPACE.match(html, at + 1).end()
            if at >= n:
                return None
            quote = html[at]
            if quote in "\"'":
                stop = html.find(quote, at + 1)
                if stop < 0:
                    return None
                value, at = html[at + 1 : stop], stop + 1
            elif quote != ">":
                end = _BARE_END.search(html, at)
                if not end:
                    return None
                value, at = html[at : end.start()], end.start()
        found.setdefault(name, value)


def start_tags(html: str) -> Iterator[tuple[str, dict[str, str]]]:
    """(name, attributes) of every start tag in order; names in lower case, values as written."""
    at, n = 0, len(html)
    while True:
        at = html.find("<", at)
        if at < 0 or at + 1 >= n:
            return
        after = html[at + 1]
        if after.isascii() and after.isalpha():
            end = _NAME_END.search(html, at + 1)
            told = end and _attributes(html, end.start())
            if not told:
                return
            name = html[at + 1 : end.start()].lower()
            yield name, told[0]
            at = told[1]
            if name in RAW_TEXT:
                stop = _RAW_END[name].search(html, at)
                if not stop:
                    return
                at = stop.start()
            elif name == "plaintext":
                return
        elif after == "/":
            letter = html[at + 2 : at + 3]
            if letter.isascii() and letter.isalpha():
                end = _NAME_END.search(html, at + 2)
                told = end and _attributes(html, end.start())  # an end tag may hold attributes, which mean nothing
                if not told:
                    return
                at = told[1]
            else:
                at = html.find(">", at + 2) + 1 or n
        elif after == "!" and html.startswith("--", at + 2):
            if html.startswith((">", "->"), at + 4):  # <!--> and <!---> are whole comments
                at = html.index(">", at + 4) + 1
            else:
                end = _COMMENT_END.search(html, at + 4)
                at = end.end() if end else n
        elif after in "!?":
            at = html.find(">", at + 2) + 1 or n
        else:
            at += 1


def _anchor_udf():
    @F.arrow_udf("array<string>")
    def anchors(pages: pa.Array) -> pa.Array:
        def one(html: str | None) -> list[str] | None:
            return None if html is None else [a["href"] for name, a in start_tags(html) if name == "a" and "href" in a]

        return pa.array([one(p) for p in pages.to_pylist()], pa.list_(pa.string()))

    return anchors


def anchor_hrefs(html: Column | str) -> Column:
    """``href`` values of the anchors of a page in order, as written (entities not decoded); NULL for NULL."""
    return _anchor_udf()(col(html))
