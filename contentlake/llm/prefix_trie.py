"""A trie of conversation prefixes: members, children, leaves and tokens saved by sharing, for every node.

1. Turns are dictionary-encoded: each distinct (role, text) gets a number. A conversation becomes the array of its numbers.
2. Equal arrays collapse to one sequence with its members' count, least id and a digest of their ids (partial aggregation; ids
   are joined in bounded blocks, and the blocks of one sequence are hashed as a stream). Sequences are dealt by ranges of
   their order, in shards of about ``SHARD_TURNS`` turns.
3. A shard is one ternary search tree over the numbers: its sequences are inserted median first, so that siblings form
   balanced search trees. The last sequence before the shard and the first after it are inserted as guards without members.
4. One iterative traversal adds up members, leaves and savings from the deepest nodes upwards. A node is counted as new
   only in the first shard it occurs in, so all sums of nodes on guard paths can be added over shards.
5. Nodes on guard paths (boundary nodes) are merged by a 128-bit hash of their path; children of boundary nodes get the
   merged parent's id.

Nothing is collected for a popular prefix: shards cut through its members. Only one sequence's numbers (8 bytes a turn) and one
shard are held by a task.

Cases: turns in order of ``turn``, null first, equal ones by the hash of role and text; null role or text is empty; rows without
conversation id belong to none; repeated rows are repeated turns; a conversation left without turns ends at the root; without
conversations there is no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import lookup_join
from ..session import known_bytes, materialize
from .tables import n_words, q

SHARD_TURNS = 200_000
#: Width of the blocks of conversation ids that are joined to one text.
ID_BLOCK = 1 << 15

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_START = b"\0" * 16
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, n_words long, new_words long, "
    "ends string, boundary boolean, key binary, parent_key binary"
)


def encoded_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, number, words): turns without their texts, equal ones with equal ``number``.

    The dictionary is made of 256-bit hashes; a turn that a third of all rows repeat is spread by the join.
    """
    role, text = (F.coalesce(q(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    thin = rows.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", mark.alias("mark"), n_words(text).alias("words"))
    thin = materialize(thin, "trie-turns")
    distinct = thin.groupBy("mark").agg(F.first("words").alias("words"))
    dictionary = materialize(distinct.withColumn("number", F.monotonically_increasing_id()), "trie-dictionary")
    return lookup_join(thin.drop("words"), dictionary, "mark", "inner", right_bytes=known_bytes(dictionary))


def conversation_arrays(turns: DataFrame) -> DataFrame:
    """(conv_id, path): a conversation's turns in order, each as number and words."""
    entry = F.struct(F.col("turn").isNotNull().alias("given"), "turn", "mark", "number", "words")
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["number"].alias("number"), t["words"].alias("words"))).alias("path"))


def borrowed_heads(conversations: DataFrame, head: Column, base: Column, most: int) -> DataFrame:
    """Each conversation's first ``head`` (at most ``most``) turns replaced by those of conversation ``base``.

    A base that is absent gives no turns. ``base`` must be shared by a bounded number of conversations.
    """
    rows = conversations.withColumn("_head", head.cast("int")).withColumn("_base", base)
    firsts = rows.select(F.col("_base").alias("_of")).distinct()
    firsts = firsts.join(conversations.select(F.col("conv_id").alias("_of"), F.slice("path", 1, most).alias("_first")), "_of")
    joined = rows.join(firsts, F.col("_base") == F.col("_of"), "left")
    none = F.slice("path", 1, 0)
    own = F.when(F.size("path") > F.col("_head"), F.slice("path", F.col("_head") + 1, F.greatest(F.size("path"), F.lit(1)))).otherwise(none)
    lent = F.coalesce(F.slice("_first", F.lit(1), F.col("_head")), none)
    return joined.select("conv_id", F.concat(lent, own).alias("path"))


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """(ids, words, members, least, ends): equal sequences with the digest of their members' ids."""
    ids, words = F.transform("path", lambda t: t["number"]), F.transform("path", lambda t: t["words"])
    keyed = conversations.select("conv_id", ids.alias("ids"), words.alias("words"))
    sign = F.unhex(F.sha2(F.to_json(F.struct("ids")), 256))
    keyed = materialize(keyed.withColumn("sign", sign), "trie-conversations")
    sequences = keyed.groupBy("sign").agg(F.first("ids").alias("ids"), F.first("words").alias("words"), F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least"))
    block = F.floor(F.col("conv_id") / ID_BLOCK)
    pieces = keyed.groupBy("sign", block.alias("block")).agg(F.array_sort(F.collect_list("conv_id")).alias("some"))
    pieces = pieces.select("sign", "block", F.array_join(F.transform("some", lambda x: x.cast("string")), ",").alias("piece"))
    pieces = pieces.repartition("sign").sortWithinPartitions("sign", "block")
    ends = pieces.mapInArrow(_stream_digests, "sign binary, ends string")
    return sequences.join(ends, "sign").drop("sign")


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for the pieces of each sign, which arrive in order; a piece is held at a time."""
    sign, state = None, None
    for batch in batches:
        signs, ends = [], []
        for s, piece in zip(batch.column("sign").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if s != sign:
                if state is not None:
                    signs.append(sign)
                    ends.append(state.hexdigest())
                sign, state = s, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(signs, pa.binary()), pa.array(ends, pa.string())], ["sign", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([sign], pa.binary()), pa.array([state.hexdigest()])], ["sign", "ends"])


class SearchTree:
    """A ternary search tree; node 0 is the root, ``same`` leads to the first child, ``low`` and ``high`` to its siblings."""

    def __init__(self) -> None:
        self.number, self.words, self.parent, self.depth = [-1], [0], [-1], [0]
        self.low, self.high, self.same = [-1], [-1], [-1]

    def _node(self, number: int, words: int, parent: int) -> int:
        for column, value in ((self.number, number), (self.words, words), (self.parent, parent), (self.depth, self.depth[parent] + 1)):
            column.append(value)
        for column in (self.low, self.high, self.same):
            column.append(-1)
        return len(self.number) - 1

    def insert(self, ids, words) -> int:
        """The node where the sequence ends."""
        at = 0
        for number, n in zip(ids, words, strict=True):
            links, child, holder = self.same, self.same[at], at
            while child >= 0 and self.number[child] != number:
                holder, links = child, self.low if number < self.number[child] else self.high
                child = links[child]
            if child < 0:
                child = links[holder] = self._node(number, n, at)
            at = child
        return at

    def path(self, at: int) -> list[int]:
        """The nodes from below the root down to ``at``."""
        out = []
        while at > 0:
            out.append(at)
            at = self.parent[at]
        return out[::-1]


def median_order(n: int) -> Iterator[int]:
    """0 .. n - 1, the middle of each open range before its halves."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            ranges += [(middle + 1, b), (a, middle)]


def shard_nodes(sequences: list[dict], before: dict | None, after: dict | None) -> dict[str, list]:
    """The nodes of one shard; ``sequences`` in order, each with ids, words, members, least and ends."""
    tree = SearchTree()
    end = [0] * len(sequences)
    for i in median_order(len(sequences)):
        end[i] = tree.insert(sequences[i]["ids"], sequences[i]["words"])
    guards = [tree.insert(g["ids"], g["words"]) if g else None for g in (before, after)]
    n = len(tree.number)
    members, least, ends = [0] * n, [None] * n, [None] * n
    for node, s in zip(end, sequences, strict=True):
        members[node], least[node], ends[node] = s["members"], s["least"], s["ends"]
    earlier, boundary, key = [False] * n, [False] * n, [None] * n
    boundary[0], key[0], earlier[0] = True, _START, before is not None
    for guard, is_before in ((guards[0], True), (guards[1], False)):
        if guard is None:
            continue
        mark = _START
        for node in tree.path(guard):
            mark = hashlib.blake2b(mark + tree.number[node].to_bytes(8, "big"), digest_size=16).digest()
            boundary[node], key[node] = True, mark
            earlier[node] |= is_before
    children, leaves, total, new = [0] * n, [0] * n, [0] * n, [0] * n
    for node in range(n - 1, -1, -1):  # children have larger numbers than their parents
        if not members[node]:
            continue
        total[node] += members[node] * tree.words[node]
        new[node] += 0 if earlier[node] else tree.words[node]
        if tree.same[node] < 0:
            leaves[node] = 1
        up = tree.parent[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            children[up] += not earlier[node]
            leaves[up] += leaves[node]
            total[up] += total[node]
            new[up] += new[node]
    kept = [v for v in range(n) if members[v]]
    above = [tree.parent[v] for v in kept]
    pick = lambda column: [column[v] for v in kept]
    return {
        "conv_id": pick(least), "depth": pick(tree.depth),
        "parent_conv_id": [None if u < 0 or boundary[u] else least[u] for u in above],
        "n_convs": pick(members), "n_children": pick(children), "n_leaves": pick(leaves), "n_words": pick(total), "new_words": pick(new),
        "ends": pick(ends), "boundary": pick(boundary), "key": pick(key),
        "parent_key": [key[u] if u >= 0 and boundary[u] else None for u in above],
    }


_KINDS = [pa.int64()] * 8 + [pa.string(), pa.bool_(), pa.binary(), pa.binary()]


def _shard(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    own = sorted((r for r in rows if r["side"] == 0), key=lambda r: r["ids"])
    guards = {r["side"]: r for r in rows if r["side"]}
    columns = shard_nodes(own, guards.get(-1), guards.get(1))
    return pa.table({name: pa.array(v, kind) for (name, v), kind in zip(columns.items(), _KINDS, strict=True)})


def prefix_nodes(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``sequences`` as of :func:`distinct_sequences`.
    """
    stored = materialize(sequences, "trie-sequences")
    # an array counts by its JSON text, about 12 bytes a turn in both columns
    shards = max(1, stored.observed["bytes"] // (12 * shard_turns))
    dealt = stored.repartitionByRange(int(shards), "ids").withColumn("shard", F.spark_partition_id())
    dealt = materialize(dealt, "trie-shards")
    # the neighbours of each shard: a row per shard, in the order of shards
    entry = F.struct("ids", "words")
    edges = dealt.groupBy("shard").agg(F.min(entry).alias("first"), F.max(entry).alias("last"))
    order = Window.orderBy("shard")
    edges = edges.select("shard", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    guards = edges.select("shard", F.explode(F.array(F.struct(F.lit(-1).alias("side"), F.col("before").alias("g")), F.struct(F.lit(1).alias("side"), F.col("after").alias("g")))).alias("e"))
    guards = guards.filter("e.g is not null").select("shard", "e.side", "e.g.ids", "e.g.words", F.lit(0).cast("long").alias("members"), F.lit(None).cast("long").alias("least"), F.lit(None).cast("string").alias("ends"))
    names = guards.columns
    units = dealt.withColumn("side", F.lit(0)).select(names).unionByName(guards)
    nodes = materialize(units.groupBy("shard").applyInArrow(_shard, NODES), "trie-nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "n_words", "new_words")]
    merged = nodes.filter("boundary").groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), *sums, F.max("ends").alias("ends"))
    merged = materialize(merged.withColumn("parent_conv_id", F.lit(None).cast("long")), "trie-boundary")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "n_words", "new_words", "ends", "parent_key"]
    inner = nodes.filter("not boundary")
    below = inner.filter("parent_key is not null").select(columns).unionByName(merged.select(columns))
    parents = materialize(merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_up")), "trie-parents")
    below = lookup_join(below, parents, "parent_key", "left", right_bytes=known_bytes(parents)).withColumn("parent_conv_id", F.col("_up"))
    done = inner.filter("parent_key is null").select(columns).unionByName(below.select(columns))
    saved = (F.col("n_words") - F.col("new_words")).alias("saved_tokens")
    return done.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved, F.coalesce("ends", F.lit(_EMPTY_SHA)).alias("ends_sha256"))
