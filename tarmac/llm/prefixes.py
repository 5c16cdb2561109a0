"""The trie of conversation prefixes, from balanced parentheses per shard.

Every conversation is rebuilt (``rebuilt``) and becomes a sequence of turns, each turn 128 bits
of hash and a length. Equal sequences become one row with their members. The distinct sequences
are range-partitioned in the order of their turns; a shard is one range, whose trie is a string of
parentheses in that order. In it

* ``Parentheses.closes`` finds where a node's subtree ends, going over blocks by their least excess;
* the rank of "()" counts the leaves between, and cumulative arrays over the nodes in preorder give
  members and savings of a subtree as differences;
* the paths of a shard's first and last sequence, its spines, are all it can share with other shards.
  A node counts itself only in the first shard that has it (the shard sees its neighbours' nearest
  sequences), so the spines' figures add up; they alone are merged, and their children look up
  their parents there. All other rows leave the shard as they are.

Turns are in the order of ``turn`` (null first), ties by role and text, so repeated rows are two equal
turns. Null role or text is empty. Rows without ``conv_id`` belong to no conversation. Other columns are
not read. An empty table gives an empty table. Texts move once, to be ordered; a conversation is ordered by one
task whose sort spills, and what a task holds of it is 24 bytes a turn. The ids of equal
sequences are digested in order by one task that holds one id at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.tables import settle

FAMILY, MOST_SHARED = 5, 9
SHARD_TURNS = 100_000
BLOCK = 64
NO_CONVERSATION = np.iinfo(np.int64).max
NODE = ("node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, spine boolean, below_spine boolean")


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, place from 1, hash and bytes of every turn."""
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return conversations.filter("conv_id is not null").select("conv_id", "turn", role, text).select(
        "conv_id", F.row_number().over(order).cast("long").alias("place"),
        F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "role", "text").alias("b"),
        F.octet_length("text").cast("long").alias("size"))


def rebuilt(told: DataFrame) -> DataFrame:
    """The turns of every conversation c after its start is replaced by that of conversation c - c % 5.

    The first h turns come from there (all if it has fewer, none if it is not there), the others are c's own
    after its first h; h is the checksum of c modulo 9. Place 0 holds no turn, so every conversation has a row.
    """
    sizes = told.groupBy("conv_id").agg(F.max("place").alias("n"))
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MOST_SHARED))
    wanted = sizes.select("conv_id", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("giver"))
    givers = sizes.select(F.col("conv_id").alias("giver"), F.col("n").alias("given"))
    plan = settle(wanted.join(givers, "giver", "left").select(
        "conv_id", "h", "giver", F.coalesce(F.least("h", "given"), F.lit(0)).alias("given")), "prefix-plan")
    starts = told.filter(F.col("place") < MOST_SHARED).withColumnRenamed("conv_id", "giver").join(
        plan, "giver").filter("place <= given").select("conv_id", "place", "a", "b", "size")
    own = told.join(plan, "conv_id").filter("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("place"), "a", "b", "size")
    zero = F.lit(0).cast("long")
    return starts.union(own).union(plan.select("conv_id", zero, zero, zero, zero))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per key, in order: number, least and digest of its ids, which come in ascending order."""
    key, n, first, digest = None, 0, None, hashlib.sha256()
    out: list[tuple] = []
    schema = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("ends_sha256", pa.string())])
    batch_of = lambda rows: pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    for batch in batches:
        for k1, k2, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2) != key:
                if n:
                    out.append((first, n, digest.hexdigest()))
                key, n, first, digest = (k1, k2), 0, conv_id, hashlib.sha256()
            digest.update(f",{conv_id}".encode() if n else str(conv_id).encode())
            n += 1
        if out:
            yield batch_of(out)
            out = []
    if n:
        yield batch_of([(first, n, digest.hexdigest())])


def sequences(conversations: DataFrame) -> DataFrame:
    """Every distinct sequence of rebuilt turns, with its number of members, the least, and the digest of all.

    The place 0 that every conversation has is left out of ``turns``.
    """
    told = settle(turns(conversations), "prefix-turns")
    turn = F.struct("place", "a", "b", "size")
    whole = rebuilt(told).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "conv_id", F.transform(F.slice("turns", F.lit(2), F.size("turns")),
                               lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["size"].alias("size"))).alias("turns"))
    members = settle(whole.select("*", F.xxhash64(F.lit(1), "turns").alias("k1"), F.xxhash64(F.lit(2), "turns").alias("k2")),
                     "prefix-members")
    least = members.select("k1", "k2", "conv_id").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(
        _digests, "conv_id long, n long, ends_sha256 string")
    return members.select("conv_id", "turns").join(least, "conv_id")


class Parentheses:
    """A string of balanced parentheses, true for "(", with the least excess of blocks and of pairs of blocks."""

    def __init__(self, opens: np.ndarray):
        excess = np.cumsum(np.where(opens, 1, -1))
        high = np.iinfo(excess.dtype).max
        self.excess = np.concatenate([excess, np.full(-len(excess) % BLOCK, high)]).reshape(-1, BLOCK)
        self.least = [self.excess.min(axis=1)]
        while len(self.least[-1]) > 1:
            level = self.least[-1]
            self.least.append(np.concatenate([level, np.full(len(level) % 2, high)]).reshape(-1, 2).min(axis=1))

    def _within(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first place in a block, beyond column ``after``, where the excess falls to the target; -1 if none."""
        out = np.empty(len(block), np.int64)
        for at in range(0, len(block), 1 << 14):
            part = slice(at, at + (1 << 14))
            falls = (self.excess[block[part]] <= target[part, None]) & (np.arange(BLOCK) > after[part, None])
            column = falls.argmax(axis=1)
            out[part] = np.where(falls.any(axis=1), block[part] * BLOCK + column, -1)
        return out

    def closes(self, opens: np.ndarray) -> np.ndarray:
        """The place of the parenthesis that closes each of the given ones."""
        target = self.excess.ravel()[opens] - 1
        out = self._within(opens // BLOCK, opens % BLOCK, target)
        left = np.flatnonzero(out < 0)
        node, level = opens[left] // BLOCK, np.full(len(left), -1)
        for up, least in enumerate(self.least):  # up to the first right neighbour that falls so far
            beside = np.minimum(node + 1, len(least) - 1)
            found = (level < 0) & (node % 2 == 0) & (node + 1 < len(least)) & (least[beside] <= target[left])
            node, level = np.where(found, beside, node), np.where(found, up, level)
            node = np.where(level < 0, node // 2, node)
        for down in range(len(self.least) - 1, 0, -1):  # and down to its first block that does
            inside = level >= down
            child = np.minimum(np.where(inside, node * 2, 0), len(self.least[down - 1]) - 1)
            first = self.least[down - 1][child] <= target[left]
            node = np.where(inside, np.where(first, child, child + 1), node)
        out[left] = self._within(node, np.full(len(left), -1), target[left])
        return out


def _least_in(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least of ``size`` values from each ``first``, by the minima of runs of powers of two."""
    out = np.empty(len(first), np.int64)
    power = np.frexp(size)[1] - 1  # exact: sizes are below 2^53
    run = values
    for k in range(int(power.max(initial=0)) + 1):
        mine = np.flatnonzero(power == k)
        out[mine] = np.minimum(run[first[mine]], run[first[mine] + size[mine] - (1 << k)])
        run = np.minimum(run[:-(1 << k)], run[1 << k:]) if len(run) > 1 << k else run
    return out


def shared_length(one: list, other: list) -> int:
    n = 0
    for x, y in zip(one, other):
        if x != y:
            break
        n += 1
    return n


def shard_nodes(own: list[tuple], before: list | None, after: list | None) -> dict[str, list]:
    """The columns of ``NODE`` for the trie of sequences (turns, n, least member, digest) in order.

    ``before`` and ``after`` are the nearest sequences of the neighbouring shards, if there are any.
    """
    keys, parent, depth, size, opens = [b""], [-1], [0], [0], [True]
    ends, least, digest = {}, {}, {}
    path, last = [0], []
    for turns, n, first, sha in own:
        common = shared_length(last, turns)
        opens += [False] * (len(last) - common)
        del path[common + 1:]
        for a, b, n_bytes in turns[common:]:
            keys.append(hashlib.blake2b(keys[path[-1]] + a.to_bytes(8, "little", signed=True)
                                        + b.to_bytes(8, "little", signed=True), digest_size=16).digest())
            parent.append(path[-1])
            depth.append(len(path))
            size.append(n_bytes)
            path.append(len(keys) - 1)
            opens.append(True)
        ends[path[-1]], least[path[-1]], digest[path[-1]] = n, first, sha
        last = turns
    opens += [False] * (len(last) + 1)

    bits, nodes = np.array(opens), len(keys)
    spine = np.zeros(nodes, bool)
    spine[path] = True
    spine[:len(own[0][0]) + 1] = True  # the first sequence's nodes come first in preorder
    counted = np.ones(nodes, bool)
    if before is not None:
        counted[:shared_length(before, own[0][0]) + 1] = False
    leaf_pairs = np.concatenate([bits[:-1] & ~bits[1:], [False]])
    if after is not None and after[:len(last)] == last:
        leaf_pairs[np.flatnonzero(bits)[path[-1]]] = False

    places = np.flatnonzero(bits)
    closing = Parentheses(bits).closes(places)
    first = np.arange(nodes)
    inside = (closing - places + 1) // 2
    total = lambda values: (lambda c: c[first + inside] - c[first])(np.concatenate([[0], np.cumsum(values)]))
    given = np.zeros(nodes, np.int64)
    given[list(ends)] = list(ends.values())
    members = total(given)
    smallest = np.full(nodes, NO_CONVERSATION)
    smallest[list(least)] = list(least.values())
    smallest = _least_in(smallest, first, inside)
    rank = np.concatenate([[0], np.cumsum(leaf_pairs)])
    parents = np.array(parent)
    children = np.bincount(parents[(parents >= 0) & counted], minlength=nodes)
    above = np.maximum(parents, 0)
    return {
        "node": keys, "parent": [keys[p] if p >= 0 else None for p in parent], "conv_id": smallest, "depth": depth,
        "parent_conv_id": pa.array(smallest[above], mask=parents < 0), "n_convs": members, "n_children": children,
        "n_leaves": rank[closing + 1] - rank[places], "saved_tokens": total((members - counted) * np.array(size)),
        "ends_sha256": [digest.get(i) for i in range(nodes)], "spine": spine, "below_spine": spine[above] & (parents >= 0)}


def _shard(table: pa.Table) -> pa.Table:
    own, beside = [], {0: None, 2: None}
    for kind, turns, n, first, sha in zip(*(table.column(c).to_pylist() for c in ("kind", "turns", "n", "conv_id", "ends_sha256"))):
        sequence = [(t["a"], t["b"], t["size"]) for t in turns]
        if kind == 1:
            own.append((sequence, n, first, sha))
        else:
            beside[kind] = sequence
    return pa.Table.from_pydict(shard_nodes(sorted(own, key=lambda s: s[0]), beside[0], beside[2]), schema=pa.schema([
        ("node", pa.binary()), ("parent", pa.binary()), *((c, pa.int64()) for c in (
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
        ("ends_sha256", pa.string()), ("spine", pa.bool_()), ("below_spine", pa.bool_())]))


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per distinct prefix of rebuilt conversations.

    ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.
    """
    distinct = settle(sequences(conversations), "prefix-sequences")
    total = distinct.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    shards = settle(distinct.repartitionByRange(max(1, -(-total // shard_turns)), "turns").withColumn(
        "shard", F.spark_partition_id()), "prefix-shards")
    ends = shards.groupBy("shard").agg(F.min("turns").alias("first"), F.max("turns").alias("last"))
    order = Window.orderBy("shard")  # a row per shard
    beside = ends.select("shard", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")).select(
        "shard", F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("turns"))
                                    for kind, c in ((0, "before"), (2, "after"))]))).filter("turns is not null")
    blank = [F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("string").alias("ends_sha256")]
    rows = shards.select("shard", F.lit(1).alias("kind"), "turns", "n", "conv_id", "ends_sha256").union(
        beside.select("shard", "kind", "turns", *blank))
    nodes = settle(rows.groupBy("shard").applyInArrow(_shard, NODE), "prefix-nodes")
    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    spines = settle(nodes.filter("spine").groupBy("node", "depth").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in figures],
        F.max("ends_sha256").alias("ends_sha256")), "prefix-spines")
    columns = ["conv_id", "depth", "parent_conv_id", *figures, "ends_sha256"]
    parents = spines.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    near = spines.unionByName(nodes.filter("not spine and below_spine").select(*spines.columns)).join(
        parents, "parent", "left")
    found = near.select(*columns).union(nodes.filter("not spine and not below_spine").select(*columns))
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
