"""URL and path expressions.

Every chain below uses its input once, so nested calls stay linear in plan size.
``try_parse_url`` is not used: it yields NULL for URLs with spaces, which readers do send.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .common import WS_CHARS, bind, col, strip_ws

# File types that are not web pages.
ASSET_EXTENSIONS = [
    "png", "jpg", "jpeg", "gif", "svg", "css", "js", "json",
    "yaml", "yml", "pdf", "zip", "mp4", "woff", "ttf",
]
# Server variables found in redirect targets.
ARGS_VARIABLE = r"\$is_args\$args"
ANY_VARIABLE = r"\$[A-Za-z0-9_]+"

SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"


def _rx(c: Column, *steps: tuple[str, str]) -> Column:
    for pattern, replacement in steps:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def _literal(text: str) -> str:
    """Quote a replacement string for the regex engine."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def _fix_scheme_slashes(c: Column) -> Column:
    """Trimmed, NULL when blank, exactly two slashes after http(s)."""
    return _rx(F.nullif(strip_ws(c), F.lit("")), (r"\A(https?:)/*", "$1//"))


# A noncharacter that stands for the slashes after a scheme while the others are collapsed.
_ORIGIN_MARK = "\ufdd1"


def _tidy(c: Column) -> Column:
    """Shared tail: lower-case scheme, path only unless scheme and host exist, one trailing slash."""
    tidy = _rx(
        F.concat(c, F.lit("/")),
        (r"\A(?i:https)://", "https://"),
        (r"\A(?i:http)://", "http://"),
        (rf"\A{SCHEME}:(?=//)(?!//[^/])", ""),      # scheme without a host
        (r"\A//[^/]*", "/"),                        # host without a scheme
        (rf"\A{SCHEME}:(?!//)", "/"),               # scheme without slashes
        (rf"\A({SCHEME})://", "$1" + _ORIGIN_MARK),
        (r"/{2,}", "/"),
        (rf"\A({SCHEME}){_ORIGIN_MARK}", "$1://"),
        (rf"\A(?!/|{SCHEME}://)", "/"),
    )
    origin = rf"\A{SCHEME}://"
    lower = lambda v: F.concat(F.lower(F.regexp_extract(v, origin, 0)), F.regexp_replace(v, origin, ""))
    return bind(tidy, lambda v: F.when(v.rlike(rf"\A(?=[^:/]*[A-Z]){SCHEME}://"), lower(v)).otherwise(v))


def _without_query(c: Column) -> Column:
    return _rx(c, (r"(?s)[?#].*", ""))


def normalize_url(url: Column | str) -> Column:
    """Trimmed URL without query or fragment, single slashes, one trailing slash; blank becomes NULL."""
    return _tidy(_without_query(_fix_scheme_slashes(col(url))))


def _drop_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in a path without its leading slash."""
    segments = F.split(path, "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.array_join(tail, "/")


# A rooted path or a web address without white space around it, variables, empty and dotted segments; a query may follow.
_REGULAR = rf"\A(?:https?://[^/?#$]++|(?=/))(?:/[^./?#$][^/?#$]*+)*+/?(?:(?<![{WS_CHARS}])\z|[?#])"


def _site(origin: str) -> str:
    return re.match(rf"({SCHEME}://[^/?#]+)", origin).group(1)


def _unless_regular(url: Column | str, origin: str, rules: Callable[[Column], Column]) -> Column:
    """``rules`` of a URL. On a regular one they only drop the query and add the site and the last slash, so one pattern takes their place."""
    scheme, host = _site(origin).split("://", 1)

    def choose(v: Column) -> Column:
        path = F.substring_index(F.substring_index(v, "?", 1), "#", 1)
        site = F.when(v.startswith("/"), F.lit(f"{scheme.lower()}://{host}")).otherwise("")
        return F.when(v.rlike(_REGULAR), F.concat(site, path, F.when(path.endswith("/"), "").otherwise("/"))).otherwise(rules(v))

    return choose(F.col(url)) if isinstance(url, str) else bind(url, choose)


def _absolute(c: Column, origin: str) -> Column:
    origin = _site(origin)
    scheme = origin.split("://")[0]
    s = _rx(
        _without_query(_fix_scheme_slashes(c)),
        (r"\A//(?=[^/])", _literal(f"{scheme}://")),
        (r"\A//(?=/|\z)", "/"),
    )
    relative_dots = rf"\A(?!{SCHEME}:)(?:.*/)?\.\.?(?:/|\z)"
    s = bind(
        s,
        lambda v: F.when(
            v.rlike(relative_dots), F.concat(F.lit("/"), _drop_dot_segments(F.regexp_replace(v, r"\A/", "")))
        ).otherwise(v),
    )
    return _tidy(_rx(s, (rf"\A(?!{SCHEME}:)/?", _literal(f"{origin}/"))))


def absolute_url(url: Column | str, origin: str) -> Column:
    """Resolve against the site root ``origin`` and normalise; blank becomes NULL."""
    return _unless_regular(url, origin, lambda v: _absolute(v, origin))


def bare_url(url: Column | str) -> Column:
    """Trimmed and cut at the query: a cheap key on which :func:`absolute_url` gives the same result."""
    return F.regexp_replace(strip_ws(url), r"(?s)[?#](?<=.[?#]).*", "")


def remove_variables(text: Column | str) -> Column:
    """Delete ``$name`` tokens and collapse the slashes left behind."""
    return _rx(col(text), (ARGS_VARIABLE, ""), (ANY_VARIABLE, ""), (r"/{2,}", "/"))


def strip_vars(url: Column | str, origin: str) -> Column:
    """Remove server variables, then make absolute and normal again; '' when nothing is left."""
    return _unless_regular(
        url, origin, lambda v: F.coalesce(_absolute(remove_variables(v), origin), F.when(v.isNotNull(), F.lit("")))
    )


def clean_target(target: Column | str) -> Column:
    """A redirect target without quotes and variables."""
    unquoted = _rx(strip_ws(target), (r'\A"+|"+\z', ""), (r"\A'+|'+\z", ""))
    return remove_variables(unquoted)


def resolve_url(base: Column | str, ref: Column | str) -> Column:
    """RFC 3986 reference resolution with a base URL per row (base scheme must be hierarchical)."""

    def resolve(pair: Column) -> Column:
        b, r = pair["b"], pair["r"]
        base_scheme = F.lower(F.regexp_extract(b, rf"\A({SCHEME}):", 1))
        ref_scheme = F.lower(F.regexp_extract(r, rf"\A({SCHEME}):", 1))
        root = F.regexp_extract(b, rf"\A((?:{SCHEME}:)?(?://[^/?#]*)?)", 1)
        base_path = F.regexp_extract(b, rf"\A(?:{SCHEME}:)?(?://[^/?#]*)?([^?#]*)", 1)
        rest = F.when(ref_scheme == "", r).otherwise(F.regexp_replace(r, rf"\A{SCHEME}:", ""))
        path = F.regexp_extract(rest, r"\A([^?#]*)", 1)
        suffix = F.regexp_extract(rest, r"(?s)\A[^?#]*(.*)\z", 1)
        folder = F.regexp_replace(base_path, r"[^/]*\z", "")
        merged = F.regexp_replace(
            F.concat(F.lit("/"), F.regexp_replace(F.concat(folder, F.lit("/"), path), r"\A/+", "")), r"/{2,}(?!\z)", "/"
        )
        return (
            F.when(r == "", b)
            .when((ref_scheme != "") & (ref_scheme != base_scheme), r)
            .when(rest.rlike(r"\A//[^/?#]"), F.concat(base_scheme, F.lit(":"), rest))
            .when((path == "") & suffix.startswith("?"), F.concat(root, base_path, suffix))
            .when(path == "", F.concat(F.regexp_replace(b, r"(?s)#.*", ""), suffix))
            .when(
                path.startswith("/"),
                F.concat(root, F.lit("/"), _drop_dot_segments(F.substring(path, 2, 1 << 30)), suffix),
            )
            .otherwise(F.concat(root, F.lit("/"), _drop_dot_segments(F.substring(merged, 2, 1 << 30)), suffix))
        )

    both = F.struct(col(base).alias("b"), col(ref).alias("r"))
    return F.when(col(ref).isNotNull() & col(base).isNotNull(), bind(both, resolve))


def strip_trailing_slash(url: Column | str) -> Column:
    return F.regexp_replace(col(url), r"/+\z", "")


def url_path(url: Column | str) -> Column:
    """Path part without ``;parameters`` of the last segment."""
    path = F.regexp_extract(col(url), rf"\A(?:{SCHEME}:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*\z", "")


def url_host(url: Column | str) -> Column:
    """Authority part, exactly as written."""
    return F.regexp_extract(col(url), rf"\A(?:{SCHEME}:)?//([^/?#]*)", 1)


def is_webpage(url: Column | str) -> Column:
    """False only for the listed asset file types (case-sensitive)."""
    return ~url_path(url).rlike(r"\.(?:" + "|".join(ASSET_EXTENSIONS) + r")\z")


def is_strict_subpath(base: Column | str, url: Column | str) -> Column:
    """Same authority, and below the base path; the base itself is not below."""
    prefix = F.concat(F.regexp_replace(url_path(base), r"/+\z", ""), F.lit("/"))
    return (url_host(base) == url_host(url)) & url_path(url).startswith(prefix)


def has_no_fragment(url: Column | str) -> Column:
    return ~col(url).contains("#")


def replace_literal(text: Column | str, old: str, new: str) -> Column:
    return F.replace(col(text), F.lit(old), F.lit(new))


def content_path(path: Column | str) -> Column:
    """Substring from the first ``/content/``; NULL when there is none."""
    at = F.instr(col(path), "/content/")
    return F.when(at > 0, col(path).substr(at, F.length(col(path))))


def in_includes(remainder: Column | str) -> Column:
    """Paths of shared fragments, which get no page of their own (``includes-x`` too)."""
    return col(remainder).startswith("/content/includes")


def page_url(base_url: Column, leftover: Column) -> Column:
    """Public URL of a Markdown file below ``base_url``."""
    page = _rx(leftover, (r"\A/+", ""), (r"(?i)\.md\z", ""), (r"(?:\A|/)_index\z", ""))
    return F.concat(base_url, F.lit("/"), F.when(page == "", "").otherwise(F.concat(page, F.lit("/"))))


def repo_content_path(path: Column | str, content_dir: str) -> Column:
    """``/<repository>/<folder>/<path below content_dir>`` with forward slashes; ``..`` steps for a path outside."""
    parts = content_dir.rstrip("/").split("/")
    prefix = "/" + "/".join([parts[-2] if len(parts) > 1 else "", parts[-1]])
    return F.replace(F.concat(F.lit(prefix + "/"), relative_path(path, content_dir)), F.lit("\\"), F.lit("/"))


def relative_path(path: Column | str, root: str) -> Column:
    """Path relative to ``root``, with ``..`` steps when it lies elsewhere. URI schemes are left out of both."""
    plain = lambda c: _rx(c, (r"\A[A-Za-z][A-Za-z0-9+.\-]*:/+", "/"))
    base = re.sub(r"\A[A-Za-z][A-Za-z0-9+.\-]*:/+", "/", root).rstrip("/") + "/"
    up = [p for p in base.split("/") if p]

    def lead(segments: Column) -> Column:
        same = F.coalesce(
            F.array_min(F.filter(F.sequence(F.lit(0), F.lit(len(up))), lambda i: ~F.get(segments, i).eqNullSafe(F.get(F.array(*[F.lit(u) for u in up]).cast("array<string>"), i)) | (i == len(up)))),
            F.lit(0),
        )
        return F.array_join(F.concat(F.array_repeat(F.lit(".."), F.lit(len(up)) - same), F.slice(segments, same + 1, F.size(segments))), "/")

    whole = plain(col(path))
    elsewhere = bind(F.filter(F.split(whole, "/"), lambda s: s != ""), lead)
    return F.when(whole.startswith(base), whole.substr(len(base) + 1, 1 << 30)).when(whole.startswith("/"), elsewhere).otherwise(whole)


def xml_public_link(path: Column | str, site: str) -> Column:
    """``xml/<lang>/docs/x.xml`` becomes ``<site>/<lang>/docs/x.html``."""
    web = F.replace(col(path).substr(len("xml/") + 1, 1 << 30), F.lit(".xml"), F.lit(".html"))
    return F.concat(F.lit(site.rstrip("/") + "/"), web)
