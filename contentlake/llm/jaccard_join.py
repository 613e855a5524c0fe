"""Exact n-gram Jaccard self join by a token-group matrix.

1. A document's set is that of its distinct shingles (hashes). Documents with equal sets form a class.
2. Classes are partitioned into groups of similar sets: minimum hashes in bands, connected.
3. The matrix holds, for each token, the groups whose union of members' leading tokens has it.
   Leading tokens are the first p + k of a set in hash order, p = n - ceil(s n) + 1 and k = n / 10: two
   sets of similarity s share k + 1 of them at least (the smaller k of both).
4. The overlap of two groups in the matrix bounds that of any two members. Only group pairs that reach
   the bound, and whose members can be of similar size, are opened. Tokens of more than ``HOT_GROUPS`` groups are not paired:
   their number per group lowers the bound. Groups that mainly consist of such tokens (more than k) are paired
   along them too, among themselves, and if even that is too many, along a chain of one per token.
5. The sets of a group are compared exactly with each other and with those of the groups it was opened for. Groups above
   ``BLOCK`` classes, and groups that meet more than that, are first dealt anew: the tokens of their sets are ordered by how many
   of these sets have them, and sets that share one of their first p tokens in that order are connected. What all have (a licence, a
   header) comes last and connects only sets that hold little else. No similar pair lies in two of these parts.
   A part above ``BLOCK`` classes is cut into blocks by distance to a center: with x = C without A_x and with B_x, the intersection of x and y is
   |C| - |A_x| - |A_y| + |A_x & A_y| + |B_x & B_y|. The ranges of a block decide most block pairs as all linked or not at all;
   the others are products of the differences, which are short for near copies; they are sent as pairs of strips of blocks.

Nothing depends on the size of a group of copies but counts. No pair of documents is emitted: a block travels as one row
and returns a row per class with its number of links, and a spanning forest. The products of unlike sets in one large part are
quadratic in its blocks, as the number of its links may be.

Cases: null text, empty text and text of blanks have the empty set and no link; fewer words than the
shingle size are one shingle; repeated rows are copies and linked; a null id is skipped as a component's
smallest id (null if all are); extra columns are ignored by the join and kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import lookup_join, stored
from ..session import known_bytes, limit_batches, materialize, row_count
from .components import components
from .tables import free_names, q
from .textarrays import U64, batch_words, mix, shingle_hashes

SHINGLE = 5
PERCENT = 80
BANDS, BAND_ROWS = 4, 3
HOT_GROUPS = 128
BUCKETS = 1024
BUCKET_TOKENS = 1_000_000
#: Rooms of classes at least, see ``rare_parts``.
ROOMS = 128
#: Classes and tokens of a block at most (about; one set is never cut).
BLOCK, BLOCK_TOKENS = 512, 1 << 20
#: Blocks and bytes of a strip at most (about; one block is never cut).
STRIP, STRIP_BYTES = 8, 8 << 20
COLUMNS = 4096

_BIN_STARTS = np.array([(k << 64) // (BANDS * BAND_ROWS) for k in range(BANDS * BAND_ROWS)], U64)
_SIGNS = "struct<n:int,s1:bigint,s2:bigint,bands:array<bigint>,lead:binary>"


def token_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(words, size))


def lead_size(n: int, percent: int = PERCENT) -> int:
    return min(n, n - -(-n * percent // 100) + 1 + n // 10)


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    return int(mix(tokens).sum().view(np.int64)), int(mix(tokens ^ U64(0x5851F42D4C957F2D)).sum().view(np.int64))


def bands_of(tokens: np.ndarray) -> list[int]:
    """One number per band: minima of ranges of the hash; an empty range takes the overall minimum."""
    at = np.minimum(np.searchsorted(tokens, _BIN_STARTS), len(tokens) - 1)
    low = tokens[at]
    ends = np.append(_BIN_STARTS[1:], U64(2**64 - 1))
    low = np.where((low >= _BIN_STARTS) & (low < ends), low, tokens[0]).reshape(BANDS, BAND_ROWS)
    factors = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], U64)
    return mix((mix(low) * factors).sum(1) + np.arange(BANDS, dtype=U64)).view(np.int64).tolist()


def _signs(percent: int, leads: bool):
    @F.arrow_udf(_SIGNS)
    def signs(texts: pa.Array) -> pa.Array:
        n, s1, s2, bands, lead = [], [], [], [], []
        for _, _, words, _, _, bounds in batch_words(texts):
            for k in range(len(bounds) - 1):
                tokens = token_set(words[bounds[k] : bounds[k + 1]])
                n.append(len(tokens))
                a, b = fingerprint(tokens) if len(tokens) else (0, 0)
                s1.append(a)
                s2.append(b)
                bands.append(bands_of(tokens) if leads and len(tokens) else [])
                # 48 bits of each leading token, as planes of bytes
                first = tokens[: lead_size(len(tokens), percent)] if leads else tokens[:0]
                lead.append(first.byteswap().view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int32()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(lead, pa.binary())],
            ["n", "s1", "s2", "bands", "lead"],
        )

    return signs


def _whole_sets(batches):
    """Texts replaced by their sets, a batch for each run of texts, so that a worker holds little at once."""
    for batch in batches:
        for a, b, words, _, _, bounds in batch_words(batch.column("body")):
            sets = [token_set(words[bounds[k] : bounds[k + 1]]).tobytes() for k in range(b - a)]
            names = ("grp", "size", "weight", "cid", "copies", "n")
            rest = [batch.column(c).slice(a, b - a) for c in names]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sets, pa.binary())], [*names, "tokens"])


def _lead_tokens(planes: bytes) -> np.ndarray:
    """The 48-bit numbers of a ``lead`` column value."""
    each = np.frombuffer(planes, np.uint8).reshape(6, -1)
    out = np.zeros(each.shape[1], np.int64)
    for plane in each:
        out = (out << 8) | plane
    return out


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers as eight planes of bytes: equal high bytes compress away in the shuffle."""
    return np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _deal(shift: int):
    """Entries (token, group, least and largest size class) of a batch, distinct, one packed row per bucket of tokens."""

    def deal(batches):
        for batch in batches:
            leads = [_lead_tokens(x) for x in batch.column("lead").to_pylist()]
            if not leads:
                continue
            n = [len(x) for x in leads]
            group, low, high = (np.repeat(batch.column(c).to_numpy(), n) for c in ("grp", "low", "high"))
            token = np.concatenate(leads)
            order = np.lexsort((group, token))
            token, group, low, high = token[order], group[order], low[order], high[order]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1])
            token, group, size = token[new], group[new], (low[new] << 16) | high[new]
            bucket = token >> shift
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else bucket
            ends = np.append(cut[1:], len(bucket))
            packed = [pa.array([_planes(c[a:b]) for a, b in zip(cut, ends, strict=True)] if len(bucket) else [], pa.binary()) for c in (token, group, size)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut].astype(np.int32)), *packed], ["bucket", "tokens", "groups", "sizes"])

    return deal


def run_pairs(starts: np.ndarray, sizes: np.ndarray, most: int = 1 << 20):
    """(i, j) index arrays of all pairs i < j within runs, in portions of about ``most`` pairs."""
    for m in np.unique(sizes):
        low, high = np.triu_indices(int(m), 1)
        first = starts[sizes == m]
        step = max(1, most // len(low))
        for a in range(0, len(first), step):
            some = first[a : a + step, None]
            yield (some + low).ravel(), (some + high).ravel()


def _pairs_of(starts: np.ndarray, sizes: np.ndarray, group: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, n): how many runs two groups of compatible sizes share."""
    a, b, n = (np.zeros(0, np.int64) for _ in range(3))
    low, high = size >> 16, size & 0xFFFF
    for i, j in run_pairs(starts, sizes):
        fit = (low[i] <= high[j] + 1) & (low[j] <= high[i] + 1)
        i, j = i[fit], j[fit]
        a, b, n = _sum_pairs(np.append(a, group[i]), np.append(b, group[j]), np.append(n, np.ones(len(i), np.int64)))
    return a, b, n


def _overlaps(table: pa.Table) -> pa.Table:
    """One bucket of the matrix: (a, b, n) shared tokens of two groups; (group, token, sizes) of hot tokens with kind 1."""
    token, group, size = (np.concatenate([_unplanes(x) for x in table.column(c).to_pylist()]) for c in ("tokens", "groups", "sizes"))
    order = np.lexsort((group, token))
    token, group, size = token[order], group[order], size[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1])
    token, group, size = token[new], group[new], size[new]
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    sizes = np.diff(np.append(starts, len(token)))
    hot = sizes > HOT_GROUPS
    paired = (sizes > 1) & ~hot
    a, b, n = _pairs_of(starts[paired], sizes[paired], group, size)
    member = np.repeat(hot, sizes)
    kinds = np.append(np.zeros(len(a), np.int32), np.ones(member.sum(), np.int32))
    return pa.table({"kind": kinds, "a": np.append(a, group[member]), "b": np.append(b, token[member]), "n": np.append(n, size[member])})


def _hot_overlaps(table: pa.Table) -> pa.Table:
    """Groups that share one hot token, few enough to pair."""
    order = np.argsort(table.column("grp").to_numpy(), kind="stable")
    group, size = table.column("grp").to_numpy()[order], table.column("sizes").to_numpy()[order]
    a, b, n = _pairs_of(np.zeros(1, np.int64), np.array([len(group)]), group, size) if len(group) > 1 else (group[:0], group[:0], group[:0])
    return pa.table({"a": a, "b": b, "n": n})


def _sum_pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray):
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
    return a[first], b[first], np.add.reduceat(n, first) if len(a) else n


def opened(entries: DataFrame, groups: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(pairs, chain): pairs (a, b), a < b, of groups that may hold similar members, and edges of groups to be taken as one.

    groups: (grp, k), the least k of the members.
    """
    found = materialize(entries.groupBy("bucket").applyInArrow(_overlaps, "kind int, a long, b long, n long"), "overlaps")
    hot = found.filter("kind = 1").select(F.col("a").alias("grp"), F.col("b").alias("token"), F.col("n").alias("sizes"))
    stats = groups.join(hot.groupBy("grp").agg(F.count(F.lit(1)).alias("hot")), "grp", "left")
    # groups that may be similar by hot tokens alone; one token may be lost to equal 48 bits, hence n >= k below
    enough = f"floor(k * {percent} / 100)"  # the least k of a set similar to one with k
    full = stats.filter(f"hot >= {enough}").select("grp")
    among = materialize(hot.join(full, "grp"), "hot-tokens")
    crowds = among.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("grp").alias("first"))
    few = among.join(crowds.filter(F.col("m") <= HOT_GROUPS).select("token"), "token")
    crowded = among.join(crowds.filter(F.col("m") > HOT_GROUPS), "token")
    stats = stats.join(full.withColumn("full", F.lit(True)), "grp", "left").join(crowded.groupBy("grp").agg(F.count(F.lit(1)).alias("crowd")), "grp", "left")
    stats = materialize(stats.select("grp", "k", F.coalesce("hot", F.lit(0)).alias("hot"), F.coalesce("full", F.lit(False)).alias("full"), F.coalesce("crowd", F.lit(0)).alias("crowd")), "group-bounds")
    cold_pairs = found.filter("kind = 0").select("a", "b", "n", F.lit(0).cast("long").alias("m"))
    hot_pairs = few.groupBy("token").applyInArrow(_hot_overlaps, "a long, b long, n long").select("a", "b", F.lit(0).cast("long").alias("n"), F.col("n").alias("m"))
    pairs = cold_pairs.unionByName(hot_pairs).groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    own = stats.select(*[F.col(c).alias(f"{c}_a" if c != "grp" else "a") for c in stats.columns])
    other = stats.select(*[F.col(c).alias(f"{c}_b" if c != "grp" else "b") for c in stats.columns])
    k = F.least("k_a", "k_b")
    by_cold = F.col("n") >= F.greatest(F.lit(1), k - F.least("hot_a", "hot_b"))
    by_all = F.col("full_a") & F.col("full_b") & (F.col("n") + F.col("m") >= F.greatest(F.lit(1), k - F.least("crowd_a", "crowd_b")))
    wide = pairs.join(own, "a").join(other, "b").filter(by_cold | by_all).select("a", "b")
    # crowds beyond pairing: one group per token holds them together
    chain = crowded.join(stats.filter(f"crowd > 0 and crowd >= {enough}").select("grp"), "grp").select(F.col("first").alias("a"), F.col("grp").alias("b")).filter("a <> b")
    return wide, chain.distinct()


def shared(left: list[np.ndarray], right: list[np.ndarray], gone_left: np.ndarray | None = None, gone_right: np.ndarray | None = None) -> np.ndarray:
    """Sizes of all intersections of two lists of sets: products of 0/1 matrices over common tokens.

    The first ``gone`` tokens of a set count as -1 (differences to a center, see ``_differences``).
    """
    out = np.zeros((len(left), len(right)), np.float64)
    if not left or not right:
        return out.astype(np.int64)

    def flat(sets, gone):
        n = np.array([len(x) for x in sets], np.int64)
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        sign = np.ones(n.sum(), np.float32)
        if gone is not None:
            sign[np.arange(n.sum()) < np.repeat(first + gone, n)] = -1
        return np.repeat(np.arange(len(sets)), n), np.concatenate(sets), sign

    rows, a, sign_a = flat(left, gone_left)
    cols, b, sign_b = flat(right, gone_right)
    common = np.intersect1d(a, b)
    at, bt = np.searchsorted(common, a), np.searchsorted(common, b)
    ka = np.flatnonzero((at < len(common)) & (common[np.minimum(at, len(common) - 1)] == a)) if len(common) else np.zeros(0, int)
    kb = np.flatnonzero((bt < len(common)) & (common[np.minimum(bt, len(common) - 1)] == b)) if len(common) else np.zeros(0, int)
    ka, kb = ka[np.argsort(at[ka], kind="stable")], kb[np.argsort(bt[kb], kind="stable")]
    sa, sb = at[ka], bt[kb]
    for c in range(0, len(common), COLUMNS):
        i, j = slice(*np.searchsorted(sa, [c, c + COLUMNS])), slice(*np.searchsorted(sb, [c, c + COLUMNS]))
        x, y = np.zeros((len(left), COLUMNS), np.float32), np.zeros((len(right), COLUMNS), np.float32)
        x[rows[ka[i]], sa[i] - c] = sign_a[ka[i]]
        y[cols[kb[j]], sb[j] - c] = sign_b[kb[j]]
        out += x @ y.T
    return np.rint(out).astype(np.int64)


def linked(both: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, percent: int) -> np.ndarray:
    return 100 * both >= percent * (n_left[:, None] + n_right[None, :] - both)


def _forest(link: np.ndarray) -> np.ndarray:
    """The smallest index in the component of each index of a symmetric link matrix."""
    label = np.arange(len(link))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(link)).min(1)) if len(link) else label
        if (new == label).all():
            return label
        label = new


def _compare(percent: int):
    """Links of one small unit: (cid, links, to) of the classes that have some. Side 0 meets itself, side 1 meets side 2."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        side, cid, copies = (table.column(c).to_numpy() for c in ("side", "cid", "copies"))
        tokens = [np.frombuffer(x, U64) for x in table.column("tokens").to_pylist()]
        size = np.array([len(x) for x in tokens], np.int64)
        link = np.zeros((len(cid), len(cid)), bool)
        whole = np.flatnonzero(side == 0)
        ones, twos = (whole, whole) if len(whole) else (np.flatnonzero(side == 1), np.flatnonzero(side == 2))
        both = shared([tokens[i] for i in ones], [tokens[i] for i in twos])
        link[np.ix_(ones, twos)] = linked(both, size[ones], size[twos], percent)
        link |= link.T
        np.fill_diagonal(link, False)
        some = link.any(1)
        label = _forest(link)
        return pa.table({"cid": cid[some], "links": (link.astype(np.int64) @ copies)[some], "to": cid[label][some]})

    return compare


def _differences():
    @F.arrow_udf("struct<n:int,gone:int,far:int,kept:int,tokens:binary>")
    def differences(tokens: pa.Array, center: pa.Array) -> pa.Array:
        """A set by what it lacks of a center (first ``gone`` tokens) and adds to it; ``far`` is the number of both.

        ``tokens`` holds these, or the set itself if that is shorter (``kept`` = 0, else ``gone``).
        """
        out = {name: [] for name in ("n", "gone", "far", "kept", "tokens")}
        for x, c in zip(tokens.to_pylist(), center.to_pylist(), strict=True):
            x, c = np.frombuffer(x, U64), np.frombuffer(c, U64)
            lacks, adds = np.setdiff1d(c, x, assume_unique=True), np.setdiff1d(x, c, assume_unique=True)
            far = len(lacks) + len(adds)
            whole = far > len(x)
            for name, value in (("n", len(x)), ("gone", len(lacks)), ("far", far), ("kept", -1 if whole else len(lacks)), ("tokens", x.tobytes() if whole else lacks.tobytes() + adds.tobytes())):
                out[name].append(value)
        kinds = [pa.int32()] * 4 + [pa.binary()]
        return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    return differences


def _block_links(percent: int):
    """Links of the block pairs of two strips: a packed row per block, with the links and a spanning forest of its classes."""

    def unpacked(members: pa.StructArray):
        cid, copies, n, gone, kept, tokens = (members.field(k) for k in ("cid", "copies", "n", "gone", "kept", "tokens"))
        sets = [np.frombuffer(x, U64) for x in tokens.to_pylist()]
        return *(x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (cid, copies, n, gone, kept)), sets

    def compare(table: pa.Table) -> pa.Table:
        center = table.column("center")[0].as_py()
        blocks = {name: unpacked(members.values) for name, members in zip(table.column("block").to_pylist(), table.column("members").combine_chunks(), strict=True)}
        links = {name: np.zeros(len(block[0]), np.int64) for name, block in blocks.items()}
        parent: dict[int, int] = {}
        for x, partners in zip(table.column("block").to_pylist(), table.column("partners").to_pylist(), strict=True):
            lcid, lcopies, ln, lgone, lkept, lsets = blocks[x]
            for y in partners:
                rcid, rcopies, rn, rgone, rkept, rsets = blocks[y]
                both = shared(lsets, rsets, np.maximum(lkept, 0), np.maximum(rkept, 0))
                # |x & y| = |C| - gone(x) - gone(y) + product for two differences; a set given as itself counts from its own overlap with C
                a, b = lgone[:, None], rgone[None, :]
                lwhole, rwhole = (lkept < 0)[:, None], (rkept < 0)[None, :]
                both += np.where(lwhole & rwhole, 0, center - np.where(rwhole, b, 0) - np.where(lwhole, a, 0) - np.where(lwhole | rwhole, 0, a + b))
                link = linked(both, ln, rn, percent)
                if x == y:
                    np.fill_diagonal(link, False)
                links[x] += link @ rcopies
                if x != y:
                    links[y] += lcopies @ link
                at = len(lcid) if x != y else 0
                square = np.zeros((at + len(rcid),) * 2, bool)
                square[: len(lcid), at:] = link
                square |= square.T
                label, names = _forest(square), np.append(lcid, rcid) if at else lcid
                apart = names[label] != names
                _united(parent, names[apart], names[label][apart])
        rows = [(table.column("grp")[0].as_py(), name, blocks[name][0], n, [_root(parent, c) for c in blocks[name][0].tolist()]) for name, n in links.items() if n.any()]
        kinds = [pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 3
        return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(zip(("grp", "block", "cids", "links", "tos"), kinds, strict=True))})

    return compare


def _root(parent: dict[int, int], x: int) -> int:
    while parent.get(x, x) != x:
        parent[x] = x = parent.get(parent[x], parent[x])
    return x


def _united(parent: dict[int, int], a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Joins the trees of a forest along edges; those that joined two."""
    edges = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, r = _root(parent, x), _root(parent, y)
        if p != r:
            parent[max(p, r)] = min(p, r)
            edges.append((x, y))
    return edges


_BLOCK_RESULT = "grp long, block long, cids array<long>, links array<long>, tos array<long>"


def _sum_blocks(table: pa.Table) -> pa.Table:
    """Results of one block with all strips: a row per linked class with the sum of its links, and the edges left of a spanning forest."""
    column = lambda name: [np.array(x, np.int64) for x in table.column(name).to_pylist()]
    cids, links, tos = column("cids")[0], sum(column("links")), column("tos")
    parent: dict[int, int] = {}
    edges = []
    for to in tos:
        apart = to != cids
        edges += _united(parent, cids[apart], to[apart])
    first = dict(reversed(edges))
    some = links > 0
    rows = [(c, n, first.get(c, c)) for c, n in zip(cids[some].tolist(), links[some].tolist(), strict=True)]
    rows += [(a, 0, b) for a, b in edges if first[a] != b]
    return pa.table({name: pa.array([r[k] for r in rows], pa.int64()) for k, name in enumerate(("cid", "links", "to"))})


def _parts(size: str, weight: str) -> Column:
    """Blocks of a group of ``size`` classes with ``weight`` tokens together."""
    return F.greatest(F.lit(1), F.ceil(F.col(size) / BLOCK), F.ceil(F.col(weight) / BLOCK_TOKENS)).cast("int")


def _dealt(n: Column) -> Column:
    return F.pmod(F.xxhash64("cid"), n)


def _packed(rows: DataFrame, by: list[str], more: list[Column] = ()) -> DataFrame:
    """One row per block: its classes in order, bounded by ``BLOCK`` and ``BLOCK_TOKENS``."""
    member = F.struct("cid", "copies", "n", "gone", "kept", "tokens")
    return rows.groupBy(*by).agg(F.array_sort(F.collect_list(member)).alias("members"), *more)


def _sure(percent: int, l: str, r: str) -> tuple[Column, Column]:  # noqa: E741
    """Whether all pairs of two blocks are linked, and whether none can be, by the ranges of their sizes and distances."""
    c = lambda name: F.col(name).cast("long")
    least = c("center") - c(f"{l}_gone_high") - c(f"{r}_gone_high")
    most = c("center") - c(f"{l}_gone_low") - c(f"{r}_gone_low") + F.least(c(f"{l}_far_high"), c(f"{r}_far_high"))
    most = F.least(most, c(f"{l}_n_high"), c(f"{r}_n_high"))
    all_linked = (100 + percent) * least >= percent * (c(f"{l}_n_high") + c(f"{r}_n_high"))
    return all_linked, (100 + percent) * most < percent * (c(f"{l}_n_low") + c(f"{r}_n_low"))


def _large_links(large: DataFrame, percent: int) -> DataFrame:
    """Links of groups cut into blocks: those that are sure by distances to a center, and those of the block pairs to compare.

    Near copies of one text differ from the center by few tokens, so a class travels as its difference.
    """
    centers = materialize(large.groupBy("grp").agg(F.min_by("tokens", "cid").alias("center_tokens")), "group-centers")
    told = lookup_join(large, centers, "grp", "inner", right_bytes=known_bytes(centers))
    told = told.withColumn("d", _differences()("tokens", "center_tokens")).select("grp", "cid", "copies", F.floor(F.octet_length("center_tokens") / 8).alias("center"), "d.*")
    told = told.withColumn("octave", F.floor(F.log2(F.col("far") + 1.0)).cast("long"))
    told = materialize(told, "center-distances")
    bins = told.groupBy("grp", "octave").agg(F.count(F.lit(1)).alias("size"), F.sum(F.octet_length("tokens") / 8).alias("weight"))
    bins = materialize(bins.select("grp", "octave", _parts("size", "weight").alias("parts")), "distance-bins")
    dealt = lookup_join(told, bins, ["grp", "octave"], "inner", right_bytes=known_bytes(bins))
    dealt = dealt.withColumn("block", F.col("octave") * (1 << 40) + _dealt(F.col("parts")))
    ranges = [f(c).alias(f"{c}_{name}") for c in ("n", "gone", "far") for name, f in (("low", F.min), ("high", F.max))]
    packs = _packed(dealt, ["grp", "block"], [F.first("center").alias("center"), F.count(F.lit(1)).alias("classes"), F.sum("copies").alias("total"), F.min("cid").alias("head"), F.sum(F.octet_length("tokens")).alias("heft"), *ranges])
    packs = materialize(packs, "group-blocks")

    # pairs of blocks, decided by their ranges alone where that is possible
    thin = [c for c in packs.columns if c not in ("members", "center", "grp", "heft")]
    side = lambda name: [F.col(c).alias(f"{name}_{c}") for c in thin]
    pairs = packs.select("grp", "center", *side("l")).join(packs.select("grp", *side("r")), "grp").filter("l_block <= r_block")
    all_linked, none = _sure(percent, "l", "r")
    pairs = pairs.select("grp", "l_block", "r_block", "l_classes", "l_total", "l_head", "r_total", "r_head", all_linked.alias("sure"), none.alias("never"))
    pairs = materialize(pairs.filter("sure or not never"), "block-pairs")
    sure = pairs.filter("sure and (l_block <> r_block or l_classes > 1)")
    gains = sure.select("grp", F.col("l_block").alias("block"), F.col("r_total").alias("gain"), F.col("r_head").alias("to"), (F.col("l_block") == F.col("r_block")).alias("own"))
    back = sure.filter("l_block <> r_block").select("grp", F.col("r_block").alias("block"), F.col("l_total").alias("gain"), F.col("l_head").alias("to"), F.lit(False).alias("own"))
    gains = gains.unionByName(back).groupBy("grp", "block").agg(F.sum("gain").alias("gain"), F.min("to").alias("to"), F.max("own").alias("own"))
    gains = materialize(gains, "sure-links")
    each = lookup_join(dealt.select("grp", "block", "cid", "copies"), gains, ["grp", "block"], "inner", right_bytes=known_bytes(gains))
    links = each.select("cid", (F.col("gain") - F.when(F.col("own"), F.col("copies")).otherwise(0)).alias("links"), "to")
    links = links.unionByName(sure.select(F.col("l_head").alias("cid"), F.lit(0).cast("long").alias("links"), F.col("r_head").alias("to")))

    # the others are compared by pairs of strips of blocks: a block is sent once for all its partners in a strip
    cost = F.greatest(F.lit(1 / STRIP), F.col("heft") / STRIP_BYTES)
    before = Window.partitionBy("grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    strips = packs.select("grp", "block", F.floor(F.coalesce(F.sum(cost).over(before), F.lit(0))).alias("strip"))
    strips = materialize(strips, "block-strips")
    strip = lambda name: strips.select("grp", F.col("block").alias(name), F.col("strip").alias(f"{name}_strip"))
    unsure = pairs.filter("not sure").select("grp", F.col("l_block").alias("x"), F.col("r_block").alias("y")).join(strip("x"), ["grp", "x"]).join(strip("y"), ["grp", "y"])
    sent = unsure.select("grp", "x_strip", "y_strip", F.explode(F.array(F.struct(F.col("x").alias("block"), F.col("y").alias("partner")), F.struct(F.col("y").alias("block"), F.lit(None).cast("long").alias("partner")))).alias("s"))
    sent = sent.groupBy("grp", "x_strip", "y_strip", "s.block").agg(F.collect_list("s.partner").alias("partners"))
    sent = materialize(sent, "strip-pairs")
    units = lookup_join(packs.select("grp", "block", "center", "members"), sent, ["grp", "block"], "inner", right_bytes=known_bytes(sent))
    told = units.groupBy("grp", "x_strip", "y_strip").applyInArrow(_block_links(percent), _BLOCK_RESULT)
    return links.unionByName(told.groupBy("grp", "block").applyInArrow(_sum_blocks, "cid long, links long, to long"))


def _packs(name: str, by: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row per value of ``by``, with its values of each column packed."""
    order = np.argsort(by, kind="stable")
    by = by[order]
    cut = np.flatnonzero(np.append(True, by[1:] != by[:-1])) if len(by) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(by))
    packed = [pa.array([_planes(c[order][i:j]) for i, j in zip(cut, ends, strict=True)] if len(by) else [], pa.binary()) for c in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array(by[cut].astype(np.int32)), *packed], [name, *columns])


def _unpacked(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.concatenate([_unplanes(x) for x in table.column(c).to_pylist()]) for c in names]


def _token_bucket(token: np.ndarray, shift: int) -> np.ndarray:
    return (token.view(U64) >> U64(shift)).astype(np.int32)


def _deal_sets(shift: int):
    """Entries (token, class, size of its set) of a batch, one packed row per bucket of tokens."""

    def deal(batches):
        for batch in batches:
            sets = [np.frombuffer(x, np.int64) for x in batch.column("tokens").to_pylist()]
            if sets:
                token, times = np.concatenate(sets), [len(x) for x in sets]
                cid, n = (np.repeat(batch.column(c).to_numpy(), times) for c in ("cid", "n"))
                yield _packs("bucket", _token_bucket(token, shift), {"tokens": token, "cids": cid, "sizes": n})

    return deal


def _common_tokens(rooms: int):
    """One bucket of tokens: entries of those that several sets have, with their number, one packed row per room of classes."""

    def common(table: pa.Table) -> pa.Table:
        token, cid, n = _unpacked(table, "tokens", "cids", "sizes")
        _, at, among = np.unique(token, return_inverse=True, return_counts=True)
        among = among[at]
        some = among > 1
        room = (mix(cid[some].view(U64)) % U64(rooms)).astype(np.int32)
        return pa.Table.from_batches([_packs("room", room, {"tokens": token[some], "cids": cid[some], "sizes": n[some], "among": among[some]})])

    return common


def _rare_tokens(percent: int, shift: int):
    """One room of classes: the first tokens of each, the rarest before, one packed row per bucket of tokens."""

    def rare(table: pa.Table) -> pa.Table:
        token, cid, n, among = _unpacked(table, "tokens", "cids", "sizes", "among")
        order = np.lexsort((token, among, cid))
        token, cid, n = token[order], cid[order], n[order]
        starts = np.flatnonzero(np.append(True, cid[1:] != cid[:-1]))
        sizes = np.diff(np.append(starts, len(cid)))
        # tokens of this set only come before all others
        some = np.arange(len(cid)) - np.repeat(starts, sizes) < np.repeat(sizes, sizes) + 1 + (-n * percent // 100)
        return pa.Table.from_batches([_packs("bucket", _token_bucket(token[some], shift), {"tokens": token[some], "cids": cid[some]})])

    return rare


def _token_edges(table: pa.Table) -> pa.Table:
    """One bucket of tokens: each class with the least class of each of its first tokens, distinct."""
    token, cid = _unpacked(table, "tokens", "cids")
    order = np.lexsort((cid, token))
    token, cid = token[order], cid[order]
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    head = np.repeat(cid[starts], np.diff(np.append(starts, len(token))))
    some = cid != head
    a, b, _ = _sum_pairs(cid[some], head[some], np.ones(some.sum(), np.int64))
    return pa.table({"a": a, "b": b})


def rare_parts(sets: DataFrame, weight: int, percent: int = PERCENT) -> DataFrame:
    """(cid, grp, size, weight): ``sets`` (cid, n, tokens), with ``weight`` tokens in all, dealt to parts so that no similar pair lies in two.

    Ordered by the number of sets that have a token, the first n - ceil(s n) + 1 tokens of two similar sets share one. Sets
    without a possible partner are left out. Tokens travel packed; those of one set only connect nothing and are sent once.
    """
    buckets, rooms = BUCKETS, max(ROOMS, -(-weight // BUCKET_TOKENS))
    while buckets * BUCKET_TOKENS < weight:
        buckets *= 2
    shift = 64 - buckets.bit_length() + 1
    dealt = sets.select("cid", "n", "tokens").mapInArrow(_deal_sets(shift), "bucket int, tokens binary, cids binary, sizes binary")
    common = dealt.groupBy("bucket").applyInArrow(_common_tokens(rooms), "room int, tokens binary, cids binary, sizes binary, among binary")
    rare = common.groupBy("room").applyInArrow(_rare_tokens(percent, shift), "bucket int, tokens binary, cids binary")
    edges = rare.groupBy("bucket").applyInArrow(_token_edges, "a long, b long")
    label = stored(components(edges).withColumnsRenamed({"v": "cid", "label": "grp"}), "rare-labels")
    label = materialize(lookup_join(sets.select("cid", "n"), label, "cid", "inner", right_bytes=known_bytes(label)), "rare-classes")
    sizes = materialize(label.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight")), "part-sizes")
    return materialize(lookup_join(label.select("cid", "grp"), sizes, "grp", "inner", right_bytes=known_bytes(sizes)), "rare-parts")


def group_links(members: DataFrame, pairs: DataFrame, sizes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(cid, links, to) with one or several rows per linked class: inside each group, and between the groups of each pair.

    members: grp, size and weight (classes and tokens of the group), cid, copies, n, tokens. pairs: (home, guest), the sets
    of the guest travel. sizes: (grp, size, weight) of all groups. Large groups, those with many guests, and all their guests meet in
    the parts of :func:`rare_parts`; large parts block by block, a block travelling as one row.
    """
    known = lambda name: sizes.withColumnsRenamed({"grp": name, "size": f"{name}_size", "weight": f"{name}_weight"})
    visits = materialize(pairs.join(known("home"), "home").join(known("guest"), "guest"), "group-visits")
    calls = visits.groupBy("home").agg(F.first("home_size").alias("hs"), F.first("home_weight").alias("hw"), F.sum("guest_size").alias("gs"), F.sum("guest_weight").alias("gw"))
    busy = calls.filter((_parts("hs", "hw") > 1) | (_parts("gs", "gw") > 1)).select("home")
    busy = materialize(busy.unionByName(sizes.filter((F.col("size") > 1) & (_parts("size", "weight") > 1)).select(F.col("grp").alias("home"))).distinct(), "busy-groups")
    if not row_count(busy):
        return _small_links(members, visits.select("home", "guest"), percent)

    heavy = visits.join(busy, "home", "left_semi").select(F.col("guest").alias("grp")).unionByName(busy.withColumnRenamed("home", "grp"))
    heavy = materialize(heavy.distinct(), "heavy-groups")
    # what is left are pairs with a group that stays out of the parts
    side = lambda name: heavy.select(F.col("grp").alias(name), F.lit(True).alias(f"{name}_heavy"))
    visits = visits.join(side("home"), "home", "left").join(side("guest"), "guest", "left").filter("home_heavy is null or guest_heavy is null").select("home", "guest")
    anew = materialize(lookup_join(members, heavy, "grp", "left_semi", right_bytes=known_bytes(heavy)).select("cid", "copies", "n", "tokens"), "heavy-members")
    weight = sizes.join(heavy, "grp", "left_semi").agg(F.sum("weight").alias("n")).first()["n"]
    parts = rare_parts(anew, weight, percent)
    anew = lookup_join(anew, parts, "cid", "inner", right_bytes=known_bytes(parts)).withColumn("parts", _parts("size", "weight"))
    links = _large_links(anew.filter("parts > 1"), percent)
    apart = lookup_join(members, heavy.withColumn("apart", F.lit(True)), "grp", "left", right_bytes=known_bytes(heavy))
    return links.unionByName(_small_links(apart, materialize(visits, "light-visits"), percent, anew.filter("parts = 1")))


def _small_links(members: DataFrame, visits: DataFrame, percent: int, more: DataFrame | None = None) -> DataFrame:
    """Links inside groups (but those marked ``apart``), between the groups of each visit (home, guest), and inside the groups of ``more``."""
    some = ["grp", "kind", "side", "cid", "copies", "tokens"]
    sides = lambda kind, side: [F.lit(kind).alias("kind"), F.lit(side).alias("side")]
    own = members.filter("size > 1" + (" and apart is null" if "apart" in members.columns else ""))
    meets = own.select("*", *sides(0, 0)).select(some)
    homes = materialize(visits.select(F.col("home").alias("grp")).distinct(), "homes")
    meets = meets.unionByName(lookup_join(members, homes, "grp", "left_semi", right_bytes=known_bytes(homes)).select("*", *sides(1, 1)).select(some))
    visits = stored(visits.withColumnRenamed("guest", "grp"), "visits")
    guests = lookup_join(members, visits, "grp", "inner", right_bytes=known_bytes(visits)).drop("grp").withColumnRenamed("home", "grp")
    meets = meets.unionByName(guests.select("*", *sides(1, 2)).select(some))
    if more is not None:
        meets = meets.unionByName(more.select("*", *sides(2, 0)).select(some))
    return meets.groupBy("grp", "kind").applyInArrow(_compare(percent), "cid long, links long, to long")


def _members(docs: DataFrame, sets: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """The whole sets of the wanted classes, each read from one document.

    A class whose least id belongs to one row only is looked up by that id, so its text alone is read again and nothing is
    shuffled but ids; only classes without such an id are found by their fingerprints, among the rows of repeated and null ids.
    """
    body = F.coalesce(q(text), F.lit("")).alias("body")
    columns = ["grp", "size", "weight", "cid", "copies", "n"]
    repeated = materialize(sets.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1 or key is null").select("key"), "repeated-ids")
    if row_count(repeated):
        safe = wanted.filter("rep is not null").join(repeated.withColumnRenamed("key", "rep"), "rep", "left_anti")
        direct = materialize(safe, "jaccard-direct")
        other = wanted.join(direct.select("cid"), "cid", "left_anti")
    else:
        direct, other = wanted, None
    by_key = direct.select(F.col("rep").alias("key"), *columns)
    texts = lookup_join(docs.select(q(key).alias("key"), body), by_key, "key", "inner", right_bytes=known_bytes(direct)).select(*columns, "body")
    if other is not None:
        rows = docs.select(q(key).alias("key"), body)
        rows = rows.join(repeated.withColumnRenamed("key", "again"), F.col("key").eqNullSafe(F.col("again")), "left_semi").select("body")
        rows = rows.withColumn("s", _signs(0, False)("body")).select(F.col("s.s1").alias("s1"), F.col("s.s2").alias("s2"), "body")
        texts = texts.unionByName(rows.join(other, ["s1", "s2"]).groupBy(*columns).agg(F.first("body").alias("body")))
    sets = texts.mapInArrow(_whole_sets, "grp long, size long, weight long, cid long, copies long, n int, tokens binary")
    return materialize(sets, "jaccard-members")


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: key, n_shingles, s1, s2 (fingerprint of its set), component_id, n_links, leads.

    n_links counts the other documents whose sets have a similarity of ``percent`` or more. leads marks one set of each
    component: the least by (smallest id, s1, s2), nulls last; its smallest id is component_id.
    """
    limit_batches(docs.sparkSession)
    body = F.coalesce(q(text), F.lit(""))
    sets = docs.select(q(key).alias("key"), body.alias("body")).select("key", _signs(percent, True)("body").alias("s")).select("key", "s.*")
    sets = materialize(sets, "jaccard-sets")
    filled = sets.filter("n > 0")
    classes = filled.groupBy("s1", "s2").agg(F.first("n").alias("n"), F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")

    # groups of similar sets
    banded = classes.select("cid", F.posexplode("bands").alias("band", "value"))
    heads = materialize(banded.groupBy("band", "value").agg(F.min("cid").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "bands")
    group_of = components(banded.join(heads, ["band", "value"]).select(F.col("cid").alias("a"), F.col("head").alias("b")))
    grouped = classes.join(group_of.withColumnRenamed("v", "cid"), "cid", "left").select("s1", "s2", "cid", "n", "copies", "rep", F.coalesce("label", "cid").alias("grp"))
    grouped = materialize(grouped, "jaccard-groups")

    # the token-group matrix and the pairs it opens
    total = filled.agg(F.sum(F.octet_length("lead")).alias("n")).first()["n"] or 0
    buckets = BUCKETS
    while buckets * BUCKET_TOKENS < total // 6:
        buckets *= 2
    once = filled.groupBy("s1", "s2").agg(F.first("lead").alias("lead"))
    base = 100 / percent  # as size_class: sets that can be similar are in the same or in neighbouring classes
    ranges = grouped.withColumn("c", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(base)) + 1e-9))
    ranges = ranges.groupBy("grp").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    ranges = materialize(ranges, "group-ranges")
    tagged = lookup_join(grouped, ranges, "grp", "inner", right_bytes=known_bytes(ranges)).select("s1", "s2", "grp", "low", "high")
    entries = once.join(tagged, ["s1", "s2"]).select("lead", "grp", "low", "high").mapInArrow(_deal(48 - buckets.bit_length() + 1), "bucket int, tokens binary, groups binary, sizes binary")
    groups = grouped.groupBy("grp").agg(F.min(F.floor(F.col("n") / 10)).alias("k"))
    pairs, chain = opened(entries, groups, percent)
    one = stored(components(chain).withColumnsRenamed({"v": "grp", "label": "whole"}), "chained-groups")
    grouped = lookup_join(grouped, one, "grp", "left", right_bytes=known_bytes(one)).withColumn("grp", F.coalesce("whole", "grp")).drop("whole")
    pairs = pairs.join(one.select(F.col("grp").alias("a"), F.col("whole").alias("wa")), "a", "left").join(one.select(F.col("grp").alias("b"), F.col("whole").alias("wb")), "b", "left")
    pairs = pairs.select(F.coalesce("wa", "a").alias("a"), F.coalesce("wb", "b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    # the smaller group of a pair is the guest
    sizes = grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"))
    sizes = materialize(sizes, "group-sizes")
    a_size, b_size = (sizes.select(F.col("grp").alias(c), F.col("size").alias(f"n_{c}")) for c in "ab")
    a_home = F.col("n_a") >= F.col("n_b")
    pairs = pairs.join(a_size, "a").join(b_size, "b").select(F.when(a_home, F.col("a")).otherwise(F.col("b")).alias("home"), F.when(a_home, F.col("b")).otherwise(F.col("a")).alias("guest"))
    pairs = materialize(pairs, "opened-groups")
    met = pairs.select(F.col("home").alias("grp")).unionByName(pairs.select(F.col("guest").alias("grp"))).distinct()
    open_groups = materialize(sizes.filter("size > 1").select("grp").unionByName(met).distinct().join(sizes, "grp"), "open-groups")
    wanted = lookup_join(grouped, open_groups, "grp", "inner", right_bytes=known_bytes(open_groups))
    wanted = materialize(wanted.select("s1", "s2", "grp", "size", "weight", "cid", "copies", "n", "rep"), "jaccard-wanted")
    members = _members(docs, sets, wanted, key, text)
    links = materialize(group_links(members, pairs, sizes, percent), "jaccard-links")

    label = components(links.select(F.col("cid").alias("a"), F.col("to").alias("b")))
    summed = links.groupBy("cid").agg(F.sum("links").alias("links"))
    done = classes.select("s1", "s2", "cid", "rep", "copies").join(label.withColumnRenamed("v", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = done.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("bare"), F.col("rep").alias("component_id"), F.col("s1").alias("l1"), F.col("s2").alias("l2"))).alias("least"))
    least = least.select("label", "least.*")
    done = done.join(least, "label").join(summed, "cid", "left")
    leads = ((F.col("s1") == F.col("l1")) & (F.col("s2") == F.col("l2"))).alias("leads")
    done = materialize(done.select("s1", "s2", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), leads), "jaccard-result")
    out = filled.select("key", F.col("n").cast("long").alias("n_shingles"), "s1", "s2").join(done, ["s1", "s2"])
    bare = sets.filter("n = 0").select("key", F.lit(0).cast("long").alias("n_shingles"), "s1", "s2", F.col("key").alias("component_id"), F.lit(0).cast("long").alias("n_links"), F.lit(False).alias("leads"))
    names = ["key", "n_shingles", "s1", "s2", "component_id", "n_links", "leads"]
    return out.select(names).unionByName(bare.select(names))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each component, that with the smallest id; documents without words all stay.

    If several rows have that id, or all ids are null, the set with the smallest fingerprint stays, and one row of it.
    """
    found = materialize(similar_documents(docs, key, text, percent), "jaccard-found")
    k, a, b, sign = free_names(docs, "k", "s1", "s2", "sign")
    names = [q(c) for c in docs.columns]
    again = found.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1 or key is null").select("key")
    again = materialize(again, "repeated-ids")
    kept = found.filter("n_shingles = 0 or leads and key <=> component_id").select(F.col("key").alias(k), F.col("s1").alias(a), F.col("s2").alias(b), F.col("n_shingles").alias(sign))
    if row_count(again):
        single = kept.join(again, q(k) == F.col("key"), "left_anti").filter(q(k).isNotNull())
    else:
        single = kept
    single = materialize(single.select(F.col(k)), "jaccard-kept")
    # ids of one row each decide by themselves
    out = lookup_join(docs.withColumn(k, q(key)), single, k, "inner", right_bytes=known_bytes(single)).select(*names)
    if not row_count(again):
        return out
    rows = docs.join(again.withColumnRenamed("key", k), q(key).eqNullSafe(q(k)), "left_semi").withColumn(sign, _signs(percent, False)(F.coalesce(q(text), F.lit(""))))
    rows = rows.withColumn(a, q(sign)["s1"]).withColumn(b, q(sign)["s2"])
    full = rows.filter(q(sign)["n"] > 0).drop(sign)
    leads = kept.filter(q(sign) > 0).drop(sign).distinct().withColumnsRenamed({a: a + "_", b: b + "_"})
    full = full.join(leads, q(key).eqNullSafe(q(k)) & (q(a) == q(a + "_")) & (q(b) == q(b + "_"))).dropDuplicates([key, a, b])
    return out.unionByName(full.select(*names)).unionByName(rows.filter(q(sign)["n"] == 0).select(*names))
