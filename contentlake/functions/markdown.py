"""Readable text of Markdown by a block parser and an inline parser, in Arrow batches.

Blocks (CommonMark, with tables): a stack of open containers (quotes, list items) is matched against each line; the line then
continues or starts a leaf. Paragraphs, titles and table cells go through the inline parser once all link references
are known: code spans, escapes, entities, tags, a stack of brackets for links, and delimiter runs for emphasis.

What remains is what a reader of the rendered page sees as text: markers, link targets, images, reference definitions,
tags, comments and all code blocks are gone, the text of code spans and links stays. Each block is a line of its own.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, functions as F

from .common import col

# Tags that start a block of HTML, by the CommonMark specification (section 4.6).
BLOCK_TAGS = (
    "address article aside base basefont blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li link main menu menuitem nav noframes ol optgroup option p "
    "param search section summary table tbody td tfoot th thead title tr track ul"
).split()

_ATTRIBUTE = r"""\s+[A-Za-z_:][\w.:-]*(?:\s*=\s*(?:[^\s"'=<>`]+|'[^']*'|"[^"]*"))?"""
_TAG = rf"<[A-Za-z][A-Za-z0-9-]*(?:{_ATTRIBUTE})*\s*/?>|</[A-Za-z][A-Za-z0-9-]*\s*>"
_HTML = re.compile(rf"{_TAG}|<!---?>|<!--.*?-->|<\?.*?\?>|<![A-Za-z][^>]*>|<!\[CDATA\[.*?\]\]>", re.DOTALL)
_PRE = re.compile(r"<(pre|script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.DOTALL | re.IGNORECASE)
_ENTITY = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_AUTOLINK = re.compile(r"<([A-Za-z][A-Za-z0-9+.-]{1,31}:[^\s<>]*|[\w.!#$%&'*+/=?^`{|}~-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)>")
_PUNCTUATION = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

_QUOTE = re.compile(r" {0,3}> ?")
_RULE = re.compile(r" {0,3}(?:(?:\* *){3,}|(?:- *){3,}|(?:_ *){3,})$")
_ITEM = re.compile(r"( {0,3})([-+*]|(\d{1,9})[.)])( +|$)")
_FENCE = re.compile(r" {0,3}(`{3,}(?=[^`]*$)|~{3,})")
_ATX = re.compile(r" {0,3}#{1,6}(?:[ \t]+(.*?))??(?:[ \t]+#+)?[ \t]*$")
_SETEXT = re.compile(r" {0,3}(?:=+|-+) *$")
_DIVIDER = re.compile(r" {0,3}\|? *:?-+:? *(?:\| *:?-+:? *)*\|? *$")
# starts of HTML blocks and what ends them (None: a blank line)
_HTML_STARTS = [
    (re.compile(r" {0,3}<(?:script|pre|style|textarea)(?:\s|>|$)", re.IGNORECASE), re.compile(r"</(?:script|pre|style|textarea)>", re.IGNORECASE), True),
    (re.compile(r" {0,3}<!--"), re.compile("-->"), True),
    (re.compile(r" {0,3}<\?"), re.compile(r"\?>"), True),
    (re.compile(r" {0,3}<![A-Za-z]"), re.compile(">"), True),
    (re.compile(r" {0,3}<!\[CDATA\["), re.compile(r"\]\]>"), True),
    (re.compile(rf" {{0,3}}</?(?:{'|'.join(BLOCK_TAGS)})(?:\s|/?>|$)", re.IGNORECASE), None, True),
    (re.compile(rf" {{0,3}}(?:{_TAG})\s*$"), None, False),
]
_LABEL = r"\[((?:[^\[\]\\]|\\.){1,999})\]"
# a shortcode may stand for a link target, as the site generator replaces it before Markdown is read
_TARGET = r"(?:\{\{[<%][^{}\n]*[%>]\}\}[^\s()]*|<(?:[^<>\n\\]|\\.)*>|(?!<)(?:[^\s()\\]|\\.|\((?:[^\s()\\]|\\.)*\))+)"
_TITLE = r"""(?:"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|\((?:[^()\\]|\\.)*\))"""
_DEFINITION = re.compile(rf" {{0,3}}{_LABEL}:\s*(?:<[^<>\n]*>|[^\s<]\S*)(?:\s+{_TITLE})?[ \t]*(?:\n|\Z)", re.DOTALL)
_INLINE_LINK = re.compile(rf"\(\s*(?:{_TARGET}(?:\s+{_TITLE})?)?\s*\)", re.DOTALL)
_REFERENCE = re.compile(rf"{_LABEL}|\[\]")
_SPECIAL = re.compile(r"[\\`<&\[\]!*_~]")


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" "))


def _label(text: str) -> str:
    return " ".join(text.split()).casefold()


class Blocks:
    """Leaves of a document in order: (kind, text) with kind inline, row or html, and the labels of its reference definitions."""

    def __init__(self, text: str) -> None:
        self.leaves: list[tuple[str, str]] = []
        self.labels: set[str] = set()
        self.containers: list[int] = []  # content indent of a list item, 0 for a quote
        self.kind, self.lines, self.end = None, [], None
        for line in re.split(r"\r\n?|\n", text):
            self._line(line.expandtabs(4) if "\t" in line[: len(line) - len(line.lstrip())] else line)
        self._close()

    def _close(self) -> None:
        """Ends the open leaf; definitions at the head of a paragraph become labels."""
        body = "\n".join(self.lines)
        if self.kind == "paragraph":
            while found := _DEFINITION.match(body):
                if not found[1].strip():
                    break
                self.labels.add(_label(found[1]))
                body = body[found.end() :]
            if body.strip():
                self.leaves.append(("inline", body))
        elif self.kind == "html":
            self.leaves.append(("html", body))
        elif self.kind == "table":
            self.leaves += [("row", row) for row in self.lines]
        self.kind, self.lines, self.end = None, [], None

    def _matched(self, line: str) -> tuple[int, str]:
        """How many open containers the line continues, and the rest of the line."""
        for depth, indent in enumerate(self.containers):
            if indent:
                if line.strip() and _indent(line) < indent:
                    return depth, line
                line = line[indent:]
            elif found := _QUOTE.match(line):
                line = line[found.end() :]
            else:
                return depth, line
        return len(self.containers), line

    def _line(self, line: str) -> None:
        depth, rest = self._matched(line)
        if depth == len(self.containers):
            if self.kind == "fence":
                closing = rest.strip()
                if _indent(rest) < 4 and len(closing) >= len(self.end) and set(closing) == {self.end[0]}:
                    self._close()
                return
            if self.kind == "html" and (self.end or rest.strip()):
                self.lines.append(rest)
                if self.end and self.end.search(rest):
                    self._close()
                return
        elif self.kind in ("fence", "html"):
            self._close()
        lazy = self.kind == "paragraph"
        while rest.strip() and _indent(rest) < 4:
            inside = lazy and depth == len(self.containers)
            if inside and _SETEXT.match(rest):
                break
            quote, item = _QUOTE.match(rest), None if _RULE.match(rest) else _ITEM.match(rest)
            if item and inside and (not rest[item.end() :].strip() or (item[3] and int(item[3]) != 1)):
                item = None  # an empty item, or one that starts elsewhere than at 1, interrupts no paragraph
            if not quote and not item:
                break
            self._close()
            lazy = False
            del self.containers[depth:]
            if quote:
                self.containers.append(0)
                rest = rest[quote.end() :]
            else:
                space = len(item[4]) if rest[item.end() :].strip() and len(item[4]) <= 4 else 1
                self.containers.append(len(item[1]) + len(item[2]) + space)
                rest = rest[len(item[1]) + len(item[2]) + min(space, len(item[4])) :]
            depth += 1
        if depth < len(self.containers) and not (lazy and rest.strip() and not self._starts_leaf(rest)):
            self._close()
            del self.containers[depth:]
        self._leaf(rest)

    def _starts_leaf(self, rest: str) -> bool:
        return _indent(rest) < 4 and bool(_RULE.match(rest) or _FENCE.match(rest) or _ATX.match(rest) or any(s.match(rest) and may for s, _, may in _HTML_STARTS))

    def _leaf(self, rest: str) -> None:
        if not rest.strip():
            self._close()
        elif _indent(rest) >= 4 and self.kind != "paragraph":
            self._close()  # indented code
        elif self.kind == "paragraph" and _indent(rest) >= 4:
            self.lines.append(rest.strip())
        elif self.kind == "paragraph" and len(self.lines) == 1 and "|" in rest + self.lines[0] and _DIVIDER.match(rest) and len(_cells(rest)) == len(_cells(self.lines[0])):
            self.kind = "table"
        elif self.kind == "paragraph" and _SETEXT.match(rest):
            self._close()
        elif found := _ATX.match(rest):
            self._close()
            self.leaves.append(("inline", found[1] or ""))
        elif found := _FENCE.match(rest):
            self._close()
            self.kind, self.end = "fence", found[1]
        elif _RULE.match(rest):
            self._close()
        elif start := next((s for s in _HTML_STARTS if (s[2] or self.kind != "paragraph") and s[0].match(rest)), None):
            self._close()
            self.kind, self.end, self.lines = "html", start[1], [rest]
            if self.end and self.end.search(rest):
                self._close()
        elif self.kind in ("paragraph", "table"):
            self.lines.append(rest.strip())
        else:
            self._close()
            self.kind, self.lines = "paragraph", [rest.strip()]


def _cells(row: str) -> list[str]:
    """Cells of a table row; a bar after a backslash belongs to its cell."""
    row = row.strip()
    row = row[1:] if row.startswith("|") else row
    row = row[:-1] if row.endswith("|") and not row.endswith("\\|") else row
    return [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", row)]


def _last_ends(text: str) -> dict[str, int]:
    """The last places where a comment, a tag and so on can end, by how they start: beyond them none is searched for."""
    return {start: text.rfind(end) for start, end in (("<!--", "-->"), ("<?", "?>"), ("<![", "]]>"), ("<", ">"))}


def _markup_end(text: str, at: int, last: dict[str, int]) -> int:
    """Where the tag, comment or code element at ``at`` ends; 0 if there is none."""
    if at >= next(place for start, place in last.items() if text.startswith(start, at)):
        return 0
    found = _PRE.match(text, at) or _HTML.match(text, at)
    return found.end() if found else 0


def without_markup(text: str) -> str:
    """The text of a block of HTML."""
    out, at, last = [], 0, _last_ends(text)
    while (start := text.find("<", at)) >= 0:
        out.append(text[at:start])
        at = _markup_end(text, start, last)
        if not at:
            out.append("<")
            at = start + 1
    return html.unescape("".join([*out, text[at:]]))


def inline_text(text: str, labels: set[str]) -> str:
    """The text of one paragraph, title or cell."""
    out: list[str] = []
    runs: list[list] = []  # delimiter runs: [place in out, character, count, opens, closes, original count]
    brackets: list[tuple[int, bool, int, int]] = []  # place in out, image, place in text, runs before it
    at, n = 0, len(text)
    missing: set[int] = set()  # lengths of backtick runs that do not occur again
    last = _last_ends(text)
    while at < n:
        found = _SPECIAL.search(text, at)
        if not found:
            out.append(text[at:])
            break
        if found.start() > at:
            out.append(text[at : found.start()])
            at = found.start()
        c = text[at]
        if c == "\\":
            follows = text[at + 1 : at + 2]
            taken = follows in _PUNCTUATION or follows == "\n"
            out.append(follows if taken else c)
            at += 2 if taken else 1
        elif c == "`":
            width = len(text) - at - len(text[at:].lstrip("`")) if n - at < 64 else re.compile("`+").match(text, at).end() - at
            close = None if width in missing else re.compile(rf"(?<!`)`{{{width}}}(?!`)").search(text, at + width)
            if close:
                code = text[at + width : close.start()].replace("\n", " ")
                out.append(code[1:-1] if code.strip() and code[0] == code[-1] == " " else code)
                at = close.end()
            else:
                missing.add(width)
                out.append("`" * width)
                at += width
        elif c == "<":
            if link := _AUTOLINK.match(text, at):
                out.append(link[1])
                at = link.end()
            elif end := _markup_end(text, at, last):
                at = end
            else:
                out.append(c)
                at += 1
        elif c == "&":
            entity = _ENTITY.match(text, at)
            out.append(html.unescape(entity[0]) if entity else c)
            at = entity.end() if entity else at + 1
        elif c == "[" or text.startswith("![", at):
            width = 1 if c == "[" else 2
            brackets.append((len(out), width == 2, at + width, len(runs)))
            out.append(text[at : at + width])
            at += width
        elif c == "]":
            at = _close_bracket(text, at, out, runs, brackets, labels)
        elif c == "!":
            out.append(c)
            at += 1
        else:
            end = at
            while end < n and text[end] == c:
                end += 1
            opens, closes = _flanks(text, at, end, c)
            runs.append([len(out), c, end - at, opens, closes, end - at])
            out.append(text[at:end])
            at = end
    _emphasis(out, runs, 0)
    return "".join(out)


def _close_bracket(text: str, at: int, out: list[str], runs: list[list], brackets: list[tuple], labels: set[str]) -> int:
    """Handles ``]``: a link keeps its text, an image vanishes, anything else stays as it is."""
    if not brackets:
        out.append("]")
        return at + 1
    place, image, start, before = brackets.pop()
    end = None
    if found := _INLINE_LINK.match(text, at + 1):
        end = found.end()
    elif (found := _REFERENCE.match(text, at + 1)) and found[1]:
        end = found.end() if _label(found[1]) in labels else None
    if end is None and _label(text[start:at]) in labels:
        end = found.end() if found and not found[1] and text[at + 1 : at + 2] == "[" else at + 1
    if end is None:
        out.append("]")
        return at + 1
    if image:
        del out[place:], runs[before:]
    else:
        out[place] = ""
        _emphasis(out, runs, before)
        brackets[:] = [b for b in brackets if b[1]]  # links hold no links
    return end


def _flanks(text: str, start: int, end: int, c: str) -> tuple[bool, bool]:
    """Whether a delimiter run can open and close emphasis."""
    left, right = text[start - 1 : start] or " ", text[end : end + 1] or " "
    signs = lambda x: x in _PUNCTUATION or (not x.isalnum() and not x.isspace() and not x.isascii())
    opening = not right.isspace() and (not signs(right) or left.isspace() or signs(left))
    closing = not left.isspace() and (not signs(left) or right.isspace() or signs(right))
    if c == "_":
        return opening and (not closing or signs(left)), closing and (not opening or signs(right))
    return opening, closing


def _emphasis(out: list[str], runs: list[list], bottom: int) -> None:
    """Pairs openers with closers among the runs from ``bottom`` on; paired delimiters vanish."""
    # openers by character; a closer that found none below a place need not look there again
    floor: dict[tuple, int] = {}
    stack: list[int] = []
    for i in range(bottom, len(runs)):
        run = runs[i]
        if run[4]:
            key = (run[1], run[3], run[5] % 3, run[2] if run[1] == "~" else 0)
            low = floor.get(key, 0)
            k = len(stack) - 1
            while run[2] and k >= low:
                opener = runs[stack[k]]
                same = opener[1] == run[1] and opener[2]
                odd = run[1] != "~" and (opener[4] or run[3]) and (opener[5] + run[5]) % 3 == 0 and (opener[5] % 3 or run[5] % 3)
                if not same or odd or (run[1] == "~" and opener[2] != run[2]):
                    k -= 1
                    continue
                width = opener[2] if run[1] == "~" else 2 if opener[2] >= 2 and run[2] >= 2 else 1
                for r in (opener, run):
                    r[2] -= width
                    out[r[0]] = r[1] * r[2]
                del stack[k + 1 :]
                if not opener[2]:
                    stack.pop()
                    k -= 1
            if run[2]:
                floor[key] = len(stack)
            for other, value in floor.items():
                floor[other] = min(value, len(stack))
        if run[3] and run[2] and (run[1] != "~" or run[5] <= 2):
            stack.append(i)
    del runs[bottom:]


def rendered_text(markdown: str) -> str:
    """Readable text of one document."""
    blocks = Blocks(markdown)
    lines = []
    for kind, body in blocks.leaves:
        if kind == "html":
            shown = without_markup(body)
        elif kind == "row":
            shown = " ".join(inline_text(cell, blocks.labels) for cell in _cells(body))
        else:
            shown = inline_text(body, blocks.labels)
        lines += [line.strip() for line in shown.split("\n")]
    return "\n".join(line for line in lines if line)


def _rendered_udf():
    @F.arrow_udf("string")
    def rendered(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else rendered_text(t) for t in texts.to_pylist()], pa.string())

    return rendered


def markdown_rendered(c: Column | str) -> Column:
    """Readable text of a Markdown document, NULL for NULL; see the module."""
    return _rendered_udf()(col(c))
