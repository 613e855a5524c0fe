"""Text cleaning, Markdown and readability expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

from .common import WS, bind, col, head_and_tail, replace_matches, rstrip_ws, strip_ws

# The address pattern to scrub. [\p{L}\p{N}_] is the Unicode word class.
WORD = r"[\p{L}\p{N}_]"
EMAIL = r"[\p{L}\p{N}_.\-]+@[\p{L}\p{N}_.\-]+\.[\p{L}\p{N}_]+"

# Styled spans and the shortcode that marks versions.
SPAN = r'(?isU)<span\s+style="([^"]*?)"\s*>(.*?)</span>'
BOLD_STYLES = ["font-weight:bold", "font-weight:bolder"]
NOWRAP_STYLES = ["white-space:nowrap", "white-space: nowrap"]
NO_BREAK_HYPHEN, NO_BREAK_SPACE = "&#8209;", "&nbsp;"
VERSIONS_LINE = r"(?mdU)^[^\n]*?\{\{<[\s&&[^\n]]*versions[\s&&[^\n]]+[^\n]*?>\}\}[^\n]*(?:\n|\z)"

# Entities decoded without a Python worker (ampersand last).
PLAIN_ENTITIES = [("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", "\u00a0"), ("amp", "&")]


def scrub_emails(c: Column | str) -> tuple[Column, Column]:
    """(text, removed count). White space is collapsed only where an address was removed."""
    c = col(c)
    hits = F.when(c.contains("@"), F.regexp_count(c, F.lit(EMAIL))).when(c.isNotNull(), 0)
    cleaned = strip_ws(F.regexp_replace(F.regexp_replace(c, EMAIL, ""), rf"(?U){WS}{{2,}}", " "))
    return F.when(hits > 0, cleaned).otherwise(c), hits


def _unescape_udf():
    @F.pandas_udf("string")
    def unescape(s: pd.Series) -> pd.Series:
        import html

        return s.map(html.unescape, na_action="ignore")

    return unescape


def decode_entities(c: Column | str) -> Column:
    """Decode character references; only rows with unusual ones visit a Python worker."""
    c = col(c)
    names = "|".join(name for name, _ in PLAIN_ENTITIES)
    unusual = c.rlike(rf"&(?!(?:{names});)[#A-Za-z]")
    plain = c
    for name, char in PLAIN_ENTITIES:
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(char))
    return F.when(unusual, _unescape_udf()(F.when(unusual, c))).otherwise(plain)


def collapse_ws(c: Column | str) -> Column:
    return strip_ws(F.regexp_replace(col(c), rf"(?U){WS}+", " "))


def clean_text(c: Column | str) -> Column:
    """Collapse white space, trim, and only then decode entities."""
    return decode_entities(collapse_ws(c))


def outside_front_matter(cut: Column) -> Column:
    """:func:`strip_front_matter` of a text that :func:`.common.head_and_tail` has cut at ``---`` or a part of it, cut likewise."""
    blank = r"[\s\x1c-\x1f&&[^\n]]*"
    delimiter = rf"(?mdU)^{blank}---{blank}(?:\n|\z)"

    def outside(p: Column) -> Column:
        kept = F.array_join(F.filter(p["pieces"], lambda _, i: i % 2 == 0), "")
        # the tail goes on with the last piece: an even number of pieces ends inside a block that never closes
        tail = F.when(F.size(p["pieces"]) % 2 == 0, F.lit("")).otherwise(p["tail"])
        return F.struct(kept.alias("head"), tail.alias("tail"))

    pieces = bind(cut, lambda p: F.struct(F.split(p["head"], delimiter, -1).alias("pieces"), p["tail"].alias("tail")))
    return bind(pieces, outside)


def strip_front_matter(text: Column | str, leading_only: bool = False) -> Column:
    """Drop ``---`` delimiter lines and what they enclose, anywhere in the text.

    Cutting at the delimiter lines leaves the outside in the even pieces. With
    ``leading_only`` a rule line in the body is kept: only a block on line one goes.
    """
    text = col(text)
    if leading_only:
        return F.regexp_replace(text, r"(?sd)\A---[^\S\n]*\n(?:.*?\n)??---[^\S\n]*(?:\n|\z)", "")
    stripped = bind(outside_front_matter(head_and_tail(text, ["---"])), lambda p: F.concat(p["head"], p["tail"]))
    return F.when(text.contains("---"), stripped).otherwise(text)


def remove_html_comments(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?s)<!--.*?-->", "")


def drop_version_lines(c: Column | str) -> Column:
    """Remove every line that holds a ``versions`` shortcode."""
    return F.regexp_replace(col(c), VERSIONS_LINE, "")


def spans_to_bold(text: Column | str) -> Column:
    """Bold-styled spans become ``**text**``; with a no-wrap style, hyphens and spaces stop breaking."""

    def has_any(style: Column, needles: list[str]) -> Column:
        found = style.contains(needles[0])
        for needle in needles[1:]:
            found = found | style.contains(needle)
        return found

    def build(whole: Column, style: Column, inner: Column) -> Column:
        style = F.lower(style)
        glued = F.replace(F.replace(inner, F.lit("-"), F.lit(NO_BREAK_HYPHEN)), F.lit(" "), F.lit(NO_BREAK_SPACE))
        body = F.when(has_any(style, NOWRAP_STYLES), glued).otherwise(inner)
        return F.when(has_any(style, BOLD_STYLES), F.concat(F.lit("**"), body, F.lit("**"))).otherwise(whole)

    return replace_matches(col(text), SPAN, [0, 1, 2], build)


# Applied in order by markdown_to_text: code goes, links keep their anchor text, markers vanish.
MARKDOWN_STEPS = [
    (r"(?ms)^```.*?^```[^\n]*$", ""),
    (r"(?ms)^~~~.*?^~~~[^\n]*$", ""),
    (r"(?m)^(?: {4}|\t)[^\n]*$", ""),
    (r"(?s)<!--.*?-->", ""),
    (r"(?s)<pre\b.*?</pre>", ""),
    (r"!\[[^\]\n]*\]\([^)\n]*\)", ""),
    (r"\[([^\]\n]*)\]\([^)\n]*\)", "$1"),
    (r"</?[A-Za-z][^<>]*>", ""),
    (r"(?m)^[ ]{0,3}#{1,6}[ \t]+", ""),
    (r"(?m)^[ ]{0,3}>[ ]?", ""),
    (r"(?m)^[ ]{0,3}(?:[-*+]|[0-9]+\.)[ \t]+", ""),
    (r"\*+|`+|__|~~", ""),
]


def markdown_to_text(c: Column | str) -> Column:
    """Readable text of a Markdown document; code blocks are removed."""
    text = col(c)
    for pattern, replacement in MARKDOWN_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    return text


# Flesch-Kincaid grade level (Kincaid et al. 1975).
WORDS_WEIGHT, SYLLABLES_WEIGHT, GRADE_OFFSET = 0.39, 11.8, 15.59
WORD_RUN, SENTENCE_END, VOWEL_GROUP = r"[\p{L}\p{N}_']+", r"[.!?]+", r"(?i)[aeiouy]+"


def reading_counts(c: Column | str) -> dict[str, Column]:
    """Words, sentence ends and syllables (approximated by vowel groups), one count each."""
    c = col(c)
    return {
        "words": F.regexp_count(c, F.lit(WORD_RUN)),
        "sentences": F.regexp_count(c, F.lit(SENTENCE_END)),
        "syllables": F.regexp_count(c, F.lit(VOWEL_GROUP)),
    }


def reading_grade(words: Column, sentences: Column, syllables: Column) -> tuple[Column, Column]:
    """(grade rounded to one digit, error text). A text without words has no grade."""
    grade = (
        F.lit(WORDS_WEIGHT) * words.cast("double") / F.greatest(sentences, F.lit(1)).cast("double")
        + F.lit(SYLLABLES_WEIGHT) * syllables.cast("double") / words.cast("double")
        - F.lit(GRADE_OFFSET)
    )
    level = F.when(words > 0, F.round(grade * 10) / 10)
    error = F.when(words.isNull(), "no text").when(words == 0, "no words")
    return level, error


def drop_timezone(c: Column | str) -> Column:
    """Wall-clock timestamp; an offset is discarded, not applied."""
    return col(c).try_cast("timestamp_ntz")


# English month names by their first three letters.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

_CLOCK = r"(?:[ T]+([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.][0-9]+)?)?(?: ?([ap])[.]?m[.]?)?)?"
_MONTH = f"((?:{'|'.join(MONTHS)}))[a-z]*[.]?"
#: Date spellings besides ISO, month before day, with the groups of year, month, day; a clock time may follow.
DATE_SPELLINGS = [
    (r"([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})", (3, 1, 2)),
    (r"([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})", (1, 2, 3)),
    (r"([0-9]{4})([0-9]{2})([0-9]{2})", (1, 2, 3)),
    (_MONTH + r" +([0-9]{1,2}),? +([0-9]{4})", (3, 1, 2)),
    (r"(?:[a-z]{3,9}, *)?([0-9]{1,2})[ -]" + _MONTH + r"[ -]([0-9]{4})", (3, 2, 1)),
]


def _date_parts(text: Column) -> Column:
    """Year, month, day, hour, minute, second and am/pm of a date in one of the spellings, joined by ``|``."""
    found = None
    for pattern, (year, month, day) in DATE_SPELLINGS:
        whole = rf"(?i)\A{pattern}{_CLOCK}\z"
        parts = F.regexp_replace(text, whole, f"${year}|${month}|${day}|$4|$5|$6|$7")
        found = F.when(text.rlike(whole), parts) if found is None else found.when(text.rlike(whole), parts)
    return found


def _stamp(parts: Column) -> Column:
    def number(i: int) -> Column:
        # a failed cast builds an error for every row, which costs far more than this test
        part = F.get(parts, F.lit(i))
        return F.when(part.rlike(r"\A[0-9]+\z"), part.try_cast("int"))

    named = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.get(parts, F.lit(1)))).cast("int")
    half = F.lower(F.get(parts, F.lit(6)))
    hour = F.coalesce(number(3), F.lit(0))
    hour = F.when(half == "", hour).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.coalesce(number(5), F.lit(0)).cast("decimal(16,6)")
    return F.try_make_timestamp(number(0), F.coalesce(number(1), named), number(2), hour, F.coalesce(number(4), F.lit(0)), second)


def coerce_date(c: Column | str) -> Column:
    """Timestamp by ISO or one of ``DATE_SPELLINGS``, or NULL when the text is no date.

    Eight digits are a date; a longer or other run of five digits and more is none. The parts of a spelling are taken out
    once and put together in one place, which keeps the generated code small.
    """
    text = strip_ws(col(c).cast("string"))
    iso = F.when(~text.rlike(r"\A[0-9]{5,}\z"), F.try_to_timestamp(text))
    return F.coalesce(iso, bind(F.split(_date_parts(text), r"\|"), _stamp))


def ensure_period(c: Column | str) -> Column:
    trimmed = rstrip_ws(c)
    return F.when(trimmed.endswith("."), trimmed).otherwise(F.concat(trimmed, F.lit(".")))


