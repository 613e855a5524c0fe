"""Find passages of benchmark items in documents: SimHash windows, then exact weighted similarity.

Every document is read in windows of about an item's size, at each word. Sizes form classes, about 1.2 apart; an
item uses the largest class of at most ``REACH`` of its words and is fingerprinted there at its
front, middle and end, so that a passage with frayed ends still holds an equal window. A
fingerprint is the 64-bit SimHash of the window's lower-cased words. It is cut into three blocks of
bits: two fingerprints within a radius of 5 differ in at most one bit of some block, so looking up each
block among the items' blocks with no or one bit flipped finds all of them. Candidates are verified on five-word shingles: the sum of the smaller over
the sum of the larger weights, a shingle weighing its count times 1 + ln((items + 1) / (items with it + 1)).

Documents stay where they are: no shuffle. Items are broadcast in blocks of at most ``ITEM_BYTES`` of
text, one pass over the documents for each.

Cases: null or empty texts have no hits; null or wordless items are left out; items of fewer than
five words are one shingle and must agree as a whole; repeated items are reported one by one; an
empty table on either side gives no hits; a column named like the output is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import q
from .textarrays import U64, batch_words, mix, shingle_hashes, words_of

RADIUS = 5
REACH = 0.9
GROWTH = 1.2
SIMILARITY = 0.8
ITEM_BYTES = 1 << 20
STEP = 1 << 13
HIT = "array<struct<item_id:bigint,start_word:int,n_words:int,similarity:double>>"


@dataclass
class Items:
    """A block of items, prepared once on the driver."""

    ids: list[int | None]
    shingles: list[dict[int, int]]  # shingle to count
    sizes: np.ndarray  # words
    spread: dict[int, int]  # shingle to number of items that hold it
    total: int
    classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # window: fingerprints, item, offset
    tables: dict[int, list[tuple[np.ndarray, ...]]]  # window: for each bit block a sieve of low bits, values (one bit flipped or none) and owners


def size_class(n: int) -> int:
    """Largest window size of at most ``REACH`` * n words."""
    most, size = max(1, int(n * REACH)), 1
    while (bigger := max(size + 1, int(size * GROWTH))) <= most:
        size = bigger
    return size


#: (shift, width) of the bit blocks. Prints that differ in RADIUS bits differ in at most one bit of some block.
BIT_BLOCKS = ((0, 21), (21, 21), (42, 22))
SIEVE = 18
assert RADIUS // len(BIT_BLOCKS) == 1


def _block(prints: np.ndarray, shift: int, width: int) -> np.ndarray:
    return (prints.view(np.int64) >> shift) & ((1 << width) - 1)


def fingerprints(words: np.ndarray, window: int) -> np.ndarray:
    """SimHash of each run of ``window`` words: the majority of the words' bits."""
    if len(words) < window:
        return np.zeros(0, U64)
    return _majority(bit_sums(words, window), window)


def bit_sums(words: np.ndarray, widest: int) -> np.ndarray:
    """Running sums of the 64 bits of each word.

    Up to 255 words in a window, eight one-byte counters share a number: sums overflow into their
    neighbours, but differences over a window do not.
    """
    bits = np.unpackbits(mix(words).view(np.uint8)).reshape(-1, 64)
    bits = bits.view(U64) if widest < 256 else bits
    sums = np.zeros((len(words) + 1, bits.shape[1]), U64 if widest < 256 else np.int32)
    np.cumsum(bits, axis=0, dtype=sums.dtype, out=sums[1:])
    return sums


def _majority(sums: np.ndarray, window: int) -> np.ndarray:
    inside = sums[window:] - sums[:-window]
    counts = inside.view(np.uint8) if inside.dtype == U64 else inside
    return np.packbits(counts > window // 2).view(U64)


def prepare(rows: list[tuple[int | None, str]], spread: dict[int, int] | None = None, total: int | None = None) -> Items:
    """Index a block of items (id, text)."""
    ids, shingles, sizes = [], [], []
    by_window: dict[int, list[tuple[int, int, int]]] = {}
    for item, text in rows:
        words = words_of(np.frombuffer((text or "").encode(), np.uint8))[0]
        if not len(words):
            continue
        no, n, window = len(ids), len(words), size_class(len(words))
        ids.append(item)
        sizes.append(n)
        shingles.append(Counter(shingle_hashes(words).tolist()))
        prints = fingerprints(words, window)
        for at in sorted({0, (n - window) // 2, n - window}):
            by_window.setdefault(window, []).append((int(prints[at]), no, at))
    spread = Counter(s for own in shingles for s in own) if spread is None else spread
    classes, tables = {}, {}
    for window, found in by_window.items():
        prints, item, at = (np.array(x, kind) for x, kind in zip(zip(*found, strict=True), (U64, np.int64, np.int64), strict=True))
        classes[window] = (prints, item, at)
        tables[window] = []
        for shift, width in BIT_BLOCKS:
            part = _block(prints, shift, width)
            flips = np.append(0, 1 << np.arange(width))
            values = (part[:, None] ^ flips[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            present = np.zeros(1 << SIEVE, bool)
            present[values & ((1 << SIEVE) - 1)] = True
            tables[window].append((present, values[order], order // len(flips)))
    return Items(ids, shingles, np.array(sizes, np.int64), spread, len(ids) if total is None else total, classes, tables)


def near(prints: np.ndarray, items: Items, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All (window position, fingerprint number) within the radius."""
    known, places, numbers = items.classes[window][0], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for (shift, width), (present, values, owner) in zip(BIT_BLOCKS, items.tables[window], strict=True):
        hit = np.flatnonzero(present.take(_block(prints, shift, SIEVE), mode="clip"))
        own = _block(prints[hit], shift, width)
        first, last = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        n = last - first
        place = np.repeat(hit, n)
        within = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        number = owner[np.repeat(first, n) + within]
        close = np.bitwise_count(prints[place] ^ known[number]) <= RADIUS
        places.append(place[close])
        numbers.append(number[close])
    both = np.unique(np.concatenate(places) * len(known) + np.concatenate(numbers))
    return both // len(known), both % len(known)


def similarity(words: np.ndarray, items: Items, item: int) -> float:
    """Weighted Jaccard similarity of a run of words and an item."""
    own, other = Counter(shingle_hashes(words).tolist()), items.shingles[item]
    low = high = 0.0
    for s in own.keys() | other.keys():
        weight = 1 + math.log((items.total + 1) / (items.spread.get(s, 0) + 1))
        low += weight * min(own.get(s, 0), other.get(s, 0))
        high += weight * max(own.get(s, 0), other.get(s, 0))
    return low / high if high else 0.0


def hits_of(words: np.ndarray, bounds: np.ndarray, items: Items, least: float) -> list[list[tuple[int, int, int, float]]]:
    """(item, first word, words, similarity) of the best places that don't overlap, for each document."""
    out: list[list] = [[] for _ in range(len(bounds) - 1)]
    widest = max(items.classes)
    found = set()
    for a in range(0, len(words), STEP):
        some = words[a : a + STEP + widest - 1]
        sums = bit_sums(some, widest)
        for window in items.classes:
            if len(some) < window:
                continue
            prints = _majority(sums, window)[:STEP]
            place, number = near(prints, items, window)
            place = place + a
            doc = np.searchsorted(bounds, place, "right") - 1
            inside = place + window <= bounds[doc + 1]
            for p, k, d in zip(place[inside].tolist(), number[inside].tolist(), doc[inside].tolist(), strict=True):
                item, at = int(items.classes[window][1][k]), int(items.classes[window][2][k])
                found.add((d, item, max(int(bounds[d]), p - at), min(int(bounds[d + 1]), p - at + int(items.sizes[item]))))
    best: dict[tuple[int, int], list] = {}
    for d, item, start, end in found:
        value = similarity(words[start:end], items, item)
        if value >= least:
            best.setdefault((d, item), []).append((-value, start, end))
    for (d, item), places in sorted(best.items()):
        taken: list[tuple[int, int]] = []
        for value, start, end in sorted(places):
            if all(end <= s or start >= e for s, e in taken):
                taken.append((start, end))
                out[d].append((item, start - int(bounds[d]), end - start, -value))
    return out


def item_blocks(items: DataFrame, text: str, key: str) -> list[Items]:
    """The items in blocks of bounded size; shingle weights are over all items."""
    rows = items.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // ITEM_BYTES))
    blocks = []
    for k in range(parts):
        some = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k).orderBy("id", "text").collect()
        blocks.append(prepare([(r["id"], r["text"]) for r in some]))
    spread: Counter = Counter()
    for b in blocks:
        spread.update(s for own in b.shingles for s in own)
    total = sum(len(b.ids) for b in blocks)
    for b in blocks:
        b.spread, b.total = {s: spread[s] for own in b.shingles for s in own}, total
    return [b for b in blocks if b.ids]


def _finder(known: Items, least: float):
    """A function of texts that returns their hits in one block of items, which Spark sends along with it."""

    @F.arrow_udf(HIT)
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for _, _, words, _, _, bounds in batch_words(texts, size=1 << 18):
            for own in hits_of(words, bounds, known, least):
                rows.append([{"item_id": known.ids[i], "start_word": s, "n_words": n, "similarity": v} for i, s, n, v in own])
        fields = [("item_id", pa.int64()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("similarity", pa.float64())]
        return pa.array(rows, pa.list_(pa.struct(fields)))

    return find


def with_hits(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` with ``hits``: the benchmark passages in each document, best places first."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "hits" and c != text])
    columns = [_finder(block, least)(F.coalesce(q(text), F.lit(""))) for block in item_blocks(items, item_text, item_key)]
    none = F.array().cast(HIT)
    return docs.withColumn("hits", F.concat(*columns) if columns else none)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **how) -> DataFrame:
    """The documents without any benchmark passage."""
    return with_hits(docs, items, text, **how).filter(F.size("hits") == 0).select(*[q(c) for c in docs.columns])
