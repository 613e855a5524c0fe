"""Periodic runs of words, found while a suffix automaton grows, and their removal down to one period.

A run is a stretch of words that repeats with smallest period q at least ``EXPONENT`` times, has ``LEAST`` words or more
and cannot be extended. All words of a whole document are read.

1. Words become numbers. Every triple of words inside a run occurs twice in it (EXPONENT >= 3, LEAST >= 5), so only stretches of
   repeated triples can hold runs; stretches shrink until all their triples repeat within them. This only leaves out words
   that are in no run, by exact comparison.
2. Each stretch is appended word by word to a suffix automaton. Its suffix links form a tree, kept as a link-cut tree whose preferred
   paths carry one colour: the place where the strings of the path ended last. Access to the newest state walks the path to
   the root in segments of one colour and recolours it (amortised O(log n) segments and rotations).
3. A segment of colour e that holds suffixes up to length m, met at place i, says that the suffix of length d = i - e ended d words
   ago if d <= m: a square of period d ends at i. Each square whose half is no power shows up this way, and no other. Squares
   of one period at successive places are one run; the first and the last give its bounds.

The automaton takes some 500 bytes for each word of the stretch at hand; documents are done one after the other.

Cases: null, empty and blank texts have no words and no run; a null id counts as no number (nothing is rebuilt); repeated
rows are treated alike; extra columns are kept, output columns replace columns of their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tables import free_names, q

LEAST = 6
EXPONENT = 4


class Squares:
    """Suffix automaton with link-cut access; ``append`` returns the periods of the squares that end at the new word."""

    def __init__(self) -> None:
        self.length, self.link, self.next = [0], [-1], [{}]
        # link-cut tree over suffix links: children and parent of the splay trees (-1: none), colour at a splay tree's root
        self.left, self.right, self.up, self.colour = [-1], [-1], [-1], [-1]
        self.last, self.n = 0, 0

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        for column in (self.left, self.right, self.up, self.colour):
            column.append(-1)
        return len(self.length) - 1

    def append(self, word: int) -> list[int]:
        length, link, following = self.length, self.link, self.next
        new = self._state(length[self.last] + 1, 0, {})
        p = self.last
        while p >= 0 and word not in following[p]:
            following[p][word] = new
            p = link[p]
        if p >= 0:
            old = following[p][word]
            if length[old] != length[p] + 1:
                old = self._split(p, old, word)
            link[new] = old
        self.up[new] = link[new]
        self.last = new
        self.n += 1
        return self._access(new, self.n)

    def _split(self, p: int, old: int, word: int) -> int:
        """A copy of ``old`` for its strings up to length(p) + 1, put above it in the tree and on its path."""
        following, link = self.next, self.link
        copy = self._state(self.length[p] + 1, link[old], dict(following[old]))
        link[old] = copy
        while p >= 0 and following[p].get(word) == old:
            following[p][word] = copy
            p = link[p]
        self._splay(old)
        above = self.left[old]
        self.left[copy], self.left[old], self.up[copy] = above, copy, old
        if above >= 0:
            self.up[above] = copy
        return copy

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        top, y = x, up[x]
        while y >= 0 and (left[y] == top or right[y] == top):
            top, y = y, up[y]
        if top == x:
            return
        self.colour[x] = self.colour[top]
        while True:
            y = up[x]
            if y < 0 or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z >= 0 and (left[z] == y or right[z] == y):
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = right[x]
            left[y], right[x] = inner, y
        else:
            inner = left[x]
            right[y], left[x] = inner, y
        if inner >= 0:
            up[inner] = y
        up[x], up[y] = z, x
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def _access(self, x: int, place: int) -> list[int]:
        """Recolour the path from ``x`` to the root with ``place``; the distances that make squares."""
        right, up, colour, length = self.right, self.up, self.colour, self.length
        found, below, at = [], -1, x
        while at >= 0:
            self._splay(at)
            before = colour[at]
            if before > 0 and place - before <= length[at]:
                found.append(place - before)
            cut = right[at]
            if cut >= 0:
                colour[cut] = before
            right[at] = below
            below, at = at, up[at]
        self._splay(x)
        colour[x] = place
        return found


def runs_in(words: list[int], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one stretch, in order of their ends."""
    squares, open_runs, runs = Squares(), {}, []

    def close(period: int, first: int, last: int) -> None:
        length = last - first + 2 * period
        if length >= max(least, exponent * period):
            runs.append((first - 2 * period, length, period))

    for i, word in enumerate(words, 1):
        for period in squares.append(word):
            first, last = open_runs.get(period, (i, i))
            if last < i - 1:
                close(period, first, last)
                first = i
            open_runs[period] = (first, i)
    for period, (first, last) in open_runs.items():
        close(period, first, last)
    return runs


def _repeated(groups: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which (group, value) pairs occur more than once."""
    order = np.lexsort((values, groups))
    g, v = groups[order], values[order]
    same = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    twice = np.zeros(len(v), bool)
    twice[1:] = same
    twice[:-1] |= same
    out = np.zeros(len(v), bool)
    out[order] = twice
    return out


def stretches(words: np.ndarray, least: int = LEAST) -> Iterator[tuple[int, int]]:
    """(start, end) of maximal stretches of at least ``least`` words whose triples all occur twice in the stretch."""
    if len(words) < least:
        return
    # numbers of triples, exact: pairs are numbered first
    many = int(words.max()) + 1
    pair = words[:-1] * many + words[1:]
    pair = pair if many < 1 << 20 else np.unique(pair, return_inverse=True)[1]
    triple = pair[:-1] * many + words[2:]
    at = np.arange(len(triple))
    part = np.zeros(len(triple), np.int64)
    while len(at):
        keep = _repeated(part, triple[at])
        stays = keep.all()
        at, part = at[keep], part[keep]
        if not len(at):
            return
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(part) != 0)
        part = np.cumsum(new) - 1
        size = np.bincount(part)
        large = size[part] >= least - 2
        stays &= large.all()
        at, part = at[large], part[large]
        if stays:
            break
    if len(at):
        first = np.flatnonzero(np.append(True, np.diff(part) != 0))
        last = np.append(first[1:], len(at)) - 1
        for a, b in zip(at[first].tolist(), at[last].tolist(), strict=True):
            yield a, b + 3


def periodic_runs(words: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a document, sorted by start, then period."""
    runs = []
    for a, b in stretches(words, least):
        runs += [(a + s, n, p) for s, n, p in runs_in(words[a:b].tolist(), least, exponent)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first period."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover)[:-1] == 0


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal small numbers."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))


def rebuilt(words: list[bytes], crc: int | None) -> list[bytes]:
    """One document in ten, chosen by the checksum of its id, repeats a piece of its words up to the end."""
    n = len(words)
    if crc is None or crc % 10 or not n:
        return words
    g = crc // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * -(-(n - a) // p))[: n - a]


RESULT = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:binary>"
DIGEST = "struct<n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,runs_sha256:string,collapsed_sha256:string>"


def _each(texts: pa.Array, make: Callable[[int, list[bytes]], list[bytes]] | None, least: int, exponent: int):
    """(words, runs) of every text; words are split at ASCII blanks, as bytes.split does."""
    for i, text in enumerate(texts.cast(pa.large_binary())):
        words = (text.as_py() or b"").split()
        words = make(i, words) if make else words
        yield words, periodic_runs(numbered(words), least, exponent) if len(words) >= least else []


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    keep = kept_words(len(words), runs)
    return b" ".join(w for w, k in zip(words, keep, strict=True) if k)


def with_runs(df: DataFrame, text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``df`` with ``runs`` (start, length, period) and ``collapsed``, the text with one period of each run left.

    ``least`` is at least 5 and ``exponent`` at least 3. ``collapsed`` joins the kept words by single blanks.
    """
    if least < 5 or exponent < 3:
        raise ValueError("runs of fewer than three periods or five words may hide from triples of words")

    @F.arrow_udf(RESULT)
    def runs(texts: pa.Array) -> pa.Array:
        found, told = [], []
        for words, some in _each(texts, None, least, exponent):
            found.append([{"start": s, "length": n, "period": p} for s, n, p in some])
            told.append(_collapsed(words, some))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(found, kind), pa.array(told, pa.binary())], ["runs", "collapsed"])

    kept = [c for c in df.columns if c.lower() not in ("runs", "collapsed")]
    (made,) = free_names(df, "made")
    told = df.select(*[q(c) for c in kept], runs(F.coalesce(q(text), F.lit(""))).alias(made))
    return told.select(*[q(c) for c in kept], q(made)["runs"].alias("runs"), q(made)["collapsed"].cast("string").alias("collapsed"))


def run_digests(df: DataFrame, text: Column, crc: Column, name: str = "told", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``df`` with a struct ``name`` of the numbers and checksums of the runs; ``crc`` decides which texts are ``rebuilt``."""

    @F.arrow_udf(DIGEST)
    def digests(texts: pa.Array, checks: pa.Array) -> pa.Array:
        crcs = checks.to_pylist()
        columns: list[list] = [[] for _ in range(7)]
        for words, runs in _each(texts, lambda i, words: rebuilt(words, crcs[i]), least, exponent):
            start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
            lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            values = (len(runs), start, length, period, 1000 * length // period if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(_collapsed(words, runs)).hexdigest())
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return df.withColumn(name, digests(F.coalesce(text, F.lit("")), crc))
