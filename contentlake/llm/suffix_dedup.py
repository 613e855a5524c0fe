"""Repeated byte strings across documents, by longest-previous-factor arrays over sparse suffixes.

Every window of ``LENGTH`` bytes belongs to the smallest of the hashes of its ``GRAM``-byte strings (its
anchor). Equal windows have equal anchors, so the windows of one anchor, a segment of about one and a half window
lengths, only have to be compared with segments of the same anchor string.

1. Each task cuts its texts into segments and sends (anchor hash, segment hash, place), packed by
   buckets of the anchor; equal segments within a task's batch are sent once.
2. A bucket finds equal segments, all but the first of which repeat it wholly, and anchors with unlike segments. Only of these
   one segment each is cut out of its text.
3. Such segments meet per bucket of anchors. Windows that occur once are sorted out by a rolling hash; over the
   rest a suffix array is built in text order, and with its previous and next smaller positions the
   longest previous factor of each window: at ``LENGTH`` it repeats an earlier one. The same with larger positions
   finds windows that a later one repeats.
   Anchors with more than ``HOT_SEGMENTS`` unlike segments, such as the edge of a passage that very many documents
   share, are spread by a 128-bit hash of each window instead and compared there.
4. Runs of windows are united per document.

Cases: a null text is empty; texts below ``LENGTH`` bytes have no window; rows that repeat id and text
repeat each other, but share one place in the order, so that "later" keeps them alike; order
is by a hash of id and text, then position; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .tables import free_names, q
from .textarrays import BYTE_CODES, LOWER_CODES, U64, pieces, rolling, span_hashes, text_bytes

LENGTH = 200
GRAM = 64
HOT_SEGMENTS = 1000
BUCKET_ENTRIES = 50_000
BUCKET_BYTES = 1 << 19
MIN_BUCKETS, MIN_PARTS = 256, 64
_POSITION_BITS = 22
PACKED = "bucket int, entries binary, data binary"
FOUND = "kind int, d long, start long, size long, anchor long, later boolean"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by minima from both ends of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def segments(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor hash, segment hash, row, start, end) of texts that lie end to end; at most 2**22 bytes."""
    none = (np.zeros(0, U64), np.zeros(0, U64), *[np.zeros(0, np.int64)] * 3)
    n = len(data)
    if n < length:
        return none
    sums, inverse = rolling(BYTE_CODES[data])
    at = np.arange(n - gram + 1)
    grams = span_hashes(sums, inverse, at, at + gram)
    keys = ((grams >> U64(_POSITION_BITS)) << U64(_POSITION_BITS)) | at.astype(U64)  # leftmost among equals
    anchor = (sliding_min(keys, length - gram + 1) & U64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    row = np.searchsorted(bounds, np.arange(len(anchor)), "right") - 1
    valid = np.flatnonzero(np.arange(len(anchor)) + length <= bounds[row + 1])
    if not len(valid):
        return none
    new = np.ones(len(valid), bool)
    new[1:] = (anchor[valid[1:]] != anchor[valid[:-1]]) | (row[valid[1:]] != row[valid[:-1]])
    first = np.flatnonzero(new)
    starts = valid[first]
    ends = valid[np.append(first[1:] - 1, len(valid) - 1)] + length
    other, other_inverse = rolling(LOWER_CODES[data] ^ (data.astype(U64) * U64(0x9FB21C651E98DF25)))
    return grams[anchor[starts]], span_hashes(other, other_inverse, starts, ends), row[starts], starts, ends


def batch_segments(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, segment hash, row, start in the row, size) of a column of texts, run by run."""
    data, starts, ends = text_bytes(column)
    for a, b in pieces(starts, ends):
        if b > a + 1:
            order = np.arange(a, b)
            joined = data[starts[a] : ends[b - 1]] if starts[b - 1] - starts[a] == (ends[a : b - 1] - starts[a : b - 1]).sum() else np.concatenate([data[starts[k] : ends[k]] for k in order])
            bounds = np.concatenate([[0], np.cumsum(ends[a:b] - starts[a:b])])
            anchor, whole, row, s, e = segments(joined, bounds, length)
            yield anchor, whole, row + a, s - bounds[row], e - s
            continue
        step = 1 << 20  # a long text: overlapping parts; each window start lies in one of them
        for at in range(int(starts[a]), int(ends[a]), step):
            part = data[at : min(int(ends[a]), at + step + length - 1)]
            anchor, whole, _, s, e = segments(part, np.array([0, len(part)]), length)
            yield anchor, whole, np.full(len(s), a), s + (at - int(starts[a])), e - s


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers as planes of bytes, so that equal bytes lie together and compress."""
    table = np.stack([c.astype(np.int64, copy=False) if c.dtype != U64 else c.view(np.int64) for c in columns], axis=1)
    return np.ascontiguousarray(table.view(np.uint8).reshape(len(table), -1).T).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    """Rows by columns."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width * 8, -1).T).view(np.int64).reshape(-1, width)


def _runs_of(*columns: np.ndarray) -> np.ndarray:
    """First places of runs of equal rows in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def unite(d: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of spans per document."""
    order = np.lexsort((start, d))
    d, start, end = d[order], start[order], end[order]
    if not len(d):
        return d, start, end
    new_doc = np.append(True, d[1:] != d[:-1])
    shift = np.cumsum(new_doc) * (int(end.max()) + 2)  # documents end to end on one axis
    reach = np.maximum.accumulate(end + shift)
    new = np.append(True, (start + shift)[1:] > reach[:-1]) | new_doc
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(d) - 1)
    return d[first], start[first], (reach - shift)[last]


def _cut(length: int, buckets: int):
    """Step 1: segments of each batch, packed by bucket; repeats within the batch as spans in bucket -1."""

    def cut(batches):
        for batch in batches:
            found = list(batch_segments(batch.column("body"), length))
            if not found:
                continue
            anchor, whole, row, start, size = (np.concatenate(x) for x in zip(*found, strict=True))
            d = batch.column("d").to_numpy()[row]
            order = np.lexsort((start, d, whole, anchor))
            anchor, whole, d, start, size = (x[order] for x in (anchor, whole, d, start, size))
            first = _runs_of(anchor, whole)
            count = np.diff(np.append(first, len(anchor)))
            leader = np.repeat(first, count)
            later = (d != d[leader]) | (start != start[leader])
            buckets_out, entries = [], []
            if later.any():
                ud, us, ue = unite(d[later], start[later], (start + size)[later])
                buckets_out.append(-1 - int(ud[0] % buckets))
                entries.append(pack([ud, us, ue - us]))
            bucket = (anchor[first] >> U64(40)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            place, bucket = first[order], bucket[order]
            cuts = np.append(_runs_of(bucket), len(bucket))
            columns = [anchor[place], whole[place], d[place], start[place], size[place], (count > 1)[order]]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                buckets_out.append(int(bucket[a]))
                entries.append(pack([c[a:b] for c in columns]))
            yield pa.RecordBatch.from_arrays([pa.array(buckets_out, pa.int32()), pa.array(entries, pa.binary()), pa.nulls(len(entries), pa.binary())], ["bucket", "entries", "data"])

    return cut


def _spans(kind: int, d, start, size, anchor=None, later=None) -> pa.Table:
    n = len(d)
    anchor = np.zeros(n, np.int64) if anchor is None else anchor
    later = np.zeros(n, bool) if later is None else later
    kinds = np.full(n, kind, np.int32)
    return pa.table({"kind": kinds, "d": np.asarray(d, np.int64), "start": np.asarray(start, np.int64), "size": np.asarray(size, np.int64), "anchor": np.asarray(anchor, np.int64), "later": np.asarray(later, bool)})


def _meet(table: pa.Table) -> pa.Table:
    """Step 2. kind 0: spans that repeat; 1 and 2: segments to compare (2: of hot anchors); later: it occurs twice itself."""
    if table.column("bucket")[0].as_py() < 0:
        rows = np.concatenate([unpack(x, 3) for x in table.column("entries").to_pylist()])
        return _spans(0, rows[:, 0], rows[:, 1], rows[:, 2], later=np.ones(len(rows), bool))
    rows = np.concatenate([unpack(x, 6) for x in table.column("entries").to_pylist()])
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    anchor, whole, d, start, size, several = rows.T
    first = _runs_of(anchor, whole, size)
    count = np.diff(np.append(first, len(rows)))
    leader = np.repeat(first, count)
    twice = np.repeat((count > 1) | (np.add.reduceat(several, first) > 0), count)
    later = (d != d[leader]) | (start != start[leader])
    per_anchor = _runs_of(anchor[first])
    unlike = np.diff(np.append(per_anchor, len(first)))
    unlike = np.repeat(unlike, unlike)
    some = first[unlike > 1]
    kind = np.where(unlike[unlike > 1] > HOT_SEGMENTS, 2, 1)
    out = [_spans(0, d[twice], start[twice], size[twice], later=later[twice])]
    for k in (1, 2):
        s = some[kind == k]
        out.append(_spans(k, d[s], start[s], size[s], anchor[s], twice[s]))
    return pa.concat_tables(out)


def _deal(length: int, buckets: int):
    """Step 3, first half: bytes of segments by bucket of the anchor; windows of hot anchors by their hash, bucket below 0."""

    def deal(batches):
        for batch in batches:
            out: dict[int, list] = {}
            hot: list[tuple[np.ndarray, ...]] = []
            for d, text, wanted in zip(batch.column("d").to_pylist(), batch.column("body").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                raw = text.encode()
                for s in wanted:
                    part = raw[s["start"] : s["start"] + s["size"]]
                    if s["kind"] == 1:
                        out.setdefault((s["anchor"] >> 20) % buckets, []).append((s["anchor"], d, s["start"], s["size"], part))
                    else:
                        data = np.frombuffer(part, np.uint8)
                        at = np.arange(len(data) - length + 1)
                        one = span_hashes(*rolling(BYTE_CODES[data]), at, at + length)
                        two = span_hashes(*rolling(LOWER_CODES[data] ^ (data.astype(U64) * U64(0x9FB21C651E98DF25))), at, at + length)
                        hot.append((one, two, np.full(len(at), d), at + s["start"]))
            names, entries, data_ = [], [], []
            for bucket, rows in out.items():
                names.append(int(bucket))
                entries.append(pack([np.array(c, np.int64) for c in zip(*[r[:4] for r in rows], strict=True)]))
                data_.append(b"".join(r[4] for r in rows))
            if hot:
                one, two, d, at = (np.concatenate(x) for x in zip(*hot, strict=True))
                bucket = (one >> U64(20)).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                cuts = np.append(_runs_of(bucket[order]), len(order))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    some = order[a:b]
                    names.append(-1 - int(bucket[some[0]]))
                    entries.append(pack([one[some], two[some], d[some], at[some]]))
                    data_.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(entries, pa.binary()), pa.array(data_, pa.binary())], ["bucket", "entries", "data"])

    return deal


def suffix_ranks(data: np.ndarray, length: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Ranks of all positions by their first 8, 16, 32 .. bytes and by ``length`` bytes (prefix doubling).

    Positions near the end rank as if zeros followed.
    """
    padded = np.concatenate([data, np.zeros(2 * length + 8, np.uint8)]).astype(U64)
    n = len(data)
    eight = np.zeros(n + length, U64)
    for k in range(8):
        eight = (eight << U64(8)) | padded[k : k + n + length]
    levels, width = [], min(8, length)
    rank = eight if width == 8 else eight >> U64(8 * (8 - width))
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    levels.append((width, rank))
    while width < length:
        step = min(width, length - width)
        shifted = np.append(rank[step:], np.zeros(step, np.int64))
        rank = np.unique(rank * (int(rank.max()) + 1) + shifted, return_inverse=True)[1].astype(np.int64)
        width += step
        levels.append((width, rank))
    return levels, rank


def common_prefix(levels: list[tuple[int, np.ndarray]], data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Length of the common prefix of positions a and b, ``length`` at most, by descending the ranks."""
    out = np.zeros(len(a), np.int64)
    full = levels[-1][1][a] == levels[-1][1][b]
    out[full] = length
    widths = [w for w, _ in levels[:-1]][::-1]
    for width in widths:
        rank = dict(levels)[width]
        fits = ~full & (out + width <= length)
        i, j = a[fits] + out[fits], b[fits] + out[fits]
        inside = (i < len(rank)) & (j < len(rank))
        same = np.zeros(len(i), bool)
        same[inside] = rank[i[inside]] == rank[j[inside]]
        out[np.flatnonzero(fits)[same]] += width
    padded = np.append(data, np.zeros(length + 1, np.uint8))
    for _ in range(min(8, length)):  # single bytes below the first width
        open_ = np.flatnonzero(~full & (out < length))
        i, j = a[open_] + out[open_], b[open_] + out[open_]
        same = padded[i] == padded[j]
        out[open_[same]] += 1
        full[open_[~same]] = True
    return out


def nearest_smaller(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a sequence the nearest place before it, and after it, with a smaller value; -1 if none."""

    def before(values: np.ndarray) -> np.ndarray:
        link = np.arange(len(values)) - 1
        open_ = np.flatnonzero(link >= 0)
        while len(open_):
            open_ = open_[values[link[open_]] > values[open_]]
            link[open_] = link[link[open_]]  # what lies between is larger still
            open_ = open_[link[open_] >= 0]
        return link

    back = before(position[::-1])[::-1]
    return before(position), np.where(back < 0, -1, len(position) - 1 - back)


def longest_previous_factor(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For sparse suffixes at ``starts`` (ascending): longest match, up to ``length``, with an earlier one, and with a later one.

    In suffix order the best earlier match of a suffix is its previous or its next one with a
    smaller position; for later matches positions count downwards.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    levels, rank = suffix_ranks(data, length)
    order = starts[np.argsort(rank[starts], kind="stable")]
    out = []
    for position in (order, -order):
        best = np.zeros(len(order), np.int64)
        for near in nearest_smaller(position):
            has = np.flatnonzero(near >= 0)
            best[has] = np.maximum(best[has], common_prefix(levels, data, order[has], order[near[has]], length))
        by_start = np.zeros(len(order), np.int64)
        by_start[np.searchsorted(starts, order)] = best
        out.append(by_start)
    return out[0], out[1]


def _windows_once(data: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """Starts of all windows inside segments whose hash occurs more than once."""
    at = np.arange(max(0, len(data) - length + 1))
    row = np.searchsorted(bounds, at, "right") - 1
    at = at[at + length <= bounds[row + 1]]
    hashes = span_hashes(*rolling(BYTE_CODES[data]), at, at + length)
    _, place, count = np.unique(hashes, return_inverse=True, return_counts=True)
    return at[count[place] > 1]


def _match(length: int, parts: int):
    """Step 3, second half: spans of repeated windows in one bucket, packed by parts of the documents."""

    def spans(d: np.ndarray, at: np.ndarray, later: np.ndarray) -> pa.Table:
        rows = []
        for flag in (False, True):
            ud, us, ue = unite(d[later | (not flag)], at[later | (not flag)], at[later | (not flag)] + length)
            rows.append(np.stack([ud, us, ue - us, np.full(len(ud), int(flag))], axis=1))
        rows = np.concatenate(rows)
        part = rows[:, 0] % parts
        order = np.argsort(part, kind="stable")
        rows, part = rows[order], part[order]
        cuts = np.append(_runs_of(part), len(part))
        packed = [pack(list(rows[a:b].T)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table({"part": pa.array(part[cuts[:-1]].astype(np.int32)), "entries": pa.array(packed, pa.binary())})

    def match(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            rows = np.concatenate([unpack(x, 4) for x in table.column("entries").to_pylist()])
            rows = np.unique(rows, axis=0)  # sorted by window, document, position
            one, two, d, at = rows.T
            first = _runs_of(one, two)
            count = np.diff(np.append(first, len(rows)))
            twice = np.repeat(count > 1, count)
            later = np.arange(len(rows)) != np.repeat(first, count)
            return spans(d[twice], at[twice], later[twice])
        rows, texts = [], []
        for entries, data in zip(table.column("entries").to_pylist(), table.column("data").to_pylist(), strict=True):
            own = unpack(entries, 4)
            cuts = np.append(0, np.cumsum(own[:, 3]))
            rows.append(own)
            texts.extend(data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        rows = np.concatenate(rows)
        order = np.lexsort((rows[:, 2], rows[:, 1]))  # text order
        order = order[_runs_of(rows[order, 1], rows[order, 2], rows[order, 3])]
        rows, data = rows[order], np.frombuffer(b"".join(texts[k] for k in order), np.uint8)
        bounds = np.append(0, np.cumsum(rows[:, 3]))
        starts = _windows_once(data, bounds, length)
        if not len(starts):
            none = np.zeros(0, np.int64)
            return spans(none, none, none.astype(bool))
        # the repeated windows only: their runs, end to end
        _, a, b = unite(np.searchsorted(bounds, starts, "right") - 1, starts, starts + length)
        size = np.append(0, np.cumsum(b - a))
        packed = np.concatenate([data[i:j] for i, j in zip(a, b, strict=True)])
        run = np.searchsorted(a, starts, "right") - 1
        short = starts - a[run] + size[run]
        previous, following = longest_previous_factor(packed, short, length)
        row = np.searchsorted(bounds, starts, "right") - 1
        at = starts - bounds[row] + rows[row, 2]
        use = (previous >= length) | (following >= length)
        return spans(rows[row, 1][use], at[use], previous[use] >= length)

    return match


def _unite_part(table: pa.Table) -> pa.Table:
    """Step 4 for the documents of one part."""
    rows = np.concatenate([unpack(x, 4) for x in table.column("entries").to_pylist()])
    out = []
    for flag in (0, 1):
        some = rows[rows[:, 3] == flag]
        d, start, end = unite(some[:, 0], some[:, 1], some[:, 1] + some[:, 2])
        out.append(_spans(0, d, start, end - start, later=np.full(len(d), bool(flag))))
    return pa.concat_tables(out)


def repeated_spans(docs: DataFrame, key: Column, text: Column, length: int = LENGTH) -> DataFrame:
    """(d, spans, later): per document with repeats the byte spans, sorted and united, covered by a
    string of ``length`` bytes that starts elsewhere too, and those covered by a later copy of one.

    d is a hash of key and text, see :func:`document_key`. Documents without repeats have no row.
    """
    rows = docs.select(document_key(key, text).alias("d"), F.coalesce(text, F.lit("")).alias("body"))
    total = rows.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    buckets = max(MIN_BUCKETS, total * 2 // (length - GRAM + 2) // BUCKET_ENTRIES)
    met = rows.filter(F.octet_length("body") >= length).mapInArrow(_cut(length, buckets), PACKED).groupBy("bucket").applyInArrow(_meet, FOUND)
    met = materialize(met, "repeat-segments")
    wanted = met.filter("kind > 0")
    size = wanted.agg(F.sum("size").alias("n")).first()["n"] or 0
    listed = wanted.groupBy("d").agg(F.collect_list(F.struct("kind", "start", "size", "anchor")).alias("wanted"))
    cut = rows.join(listed, "d").mapInArrow(_deal(length, max(MIN_BUCKETS, size // BUCKET_BYTES)), PACKED)
    parts = max(MIN_PARTS, size // (4 * BUCKET_BYTES))
    matched = cut.groupBy("bucket").applyInArrow(_match(length, parts), "part int, entries binary").groupBy("part").applyInArrow(_unite_part, FOUND)
    spans = met.filter("kind = 0").unionByName(matched).groupBy("d").agg(
        F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("end"))).alias("spans"),
        F.collect_list(F.when(F.col("later"), F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("later"),
    )
    return spans.select("d", united(F.col("spans")).alias("spans"), united(F.col("later")).alias("later"))


SPANS = "array<struct<start:bigint,end:bigint>>"


def united(spans: Column) -> Column:
    @F.arrow_udf(SPANS)
    def unions(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        r, a, b = unite(row, flat.field("start").to_numpy(zero_copy_only=False), flat.field("end").to_numpy(zero_copy_only=False))
        offsets = np.searchsorted(r, np.arange(len(lists) + 1)).astype(np.int32)
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], fields=list(kind)))

    return unions(spans)


def document_key(key: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(6), key.cast("string"), F.coalesce(text, F.lit("")))


def with_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with ``spans`` and ``later`` (empty lists where nothing repeats)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("spans", "later") and c not in (key, text)])
    (d,) = free_names(docs, "d_")
    found = repeated_spans(docs, q(key), q(text), length).withColumnRenamed("d", d)
    none = F.array().cast(SPANS)
    out = docs.withColumn(d, document_key(q(key), q(text))).join(found, d, "left").drop(d)
    return out.withColumn("spans", F.coalesce("spans", none)).withColumn("later", F.coalesce("later", none))


def kept_bytes(raw: bytes, spans: list[dict]) -> bytes:
    out, at = [], 0
    for s in spans:
        out.append(raw[at : s["start"]])
        at = s["end"]
    return b"".join([*out, raw[at:]])


def digest(text: Column, spans: Column) -> Column:
    """struct of n_bytes, n_removed, n_spans and the SHA-256 of the other bytes."""

    @F.arrow_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>")
    def told(texts: pa.Array, lists: pa.Array) -> pa.Array:
        n, removed, count, sha = [], [], [], []
        for x, s in zip(texts.cast(pa.large_binary()).to_pylist(), lists.to_pylist(), strict=True):
            kept = kept_bytes(x, s)
            n.append(len(x))
            removed.append(len(x) - len(kept))
            count.append(len(s))
            sha.append(hashlib.sha256(kept).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())], ["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return told(F.coalesce(text, F.lit("")), spans)


def remove_later(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` without later copies; a character cut in half goes with them, a null text stays null."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array([kept_bytes(x, s).decode("utf-8", "ignore") for x, s in zip(texts.cast(pa.large_binary()).to_pylist(), lists.to_pylist(), strict=True)], pa.string())

    out = with_spans(docs, key, text, length)
    return out.withColumn(text, F.when(q(text).isNotNull(), cut(F.coalesce(q(text), F.lit("")), F.col("later")))).drop("spans", "later")
