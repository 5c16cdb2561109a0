import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import prefixes

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows):
    """Nodes of the trie from whole sequences and plain prefixes."""
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            told[conv].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [t[2:] for t in sorted(ts)] for c, ts in told.items()}
    whole = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        giver = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole[c] = tuple(told.get(giver, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
        ends[whole[c]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
            leaves[node[:d]] += not children[node]
    return sorted((m[0], len(node), members[node[:-1]][0] if node else None, len(m), children[node], leaves[node],
                   saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
                  for node, m in members.items())


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    trie = prefixes.prefix_trie(table, **options)
    assert trie.columns == COLUMNS
    return sorted((tuple(r) for r in trie.collect()), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    out = []
    for c in [*range(-12, 120), 10**15]:
        first = draw.choice(["hi", "hi", "hi", "hé", "漢"])
        length = draw.choice([1, 2, 3, 5, 12])
        for t in range(length):
            text = first if t == 0 else draw.choice(["a", "b", "", None, "long text " * 3])
            out.append((c, t, draw.choice(["user", "user", None]), text))
    for c in range(200, 260):  # equal ones, ties, no turn number, a long one
        out += [(c, t, "user", "same") for t in range(10)]
    out += [(300, 1, "b", "x"), (300, 1, "a", "y"), (300, None, "c", "z"), (300, 1, "a", "y"), (None, 1, "a", "lost")]
    out += [(305, t, "user", f"{t % 7}") for t in range(700)] + [(306, t, "user", f"{t % 7}") for t in range(650)]
    return out


@pytest.mark.parametrize("shard_turns", [prefixes.SHARD_TURNS, 40])
def test_trie_by_hand(spark, rows, shard_turns):
    expected = sorted(by_hand(rows), key=lambda r: tuple((v is not None, v) for v in r))
    assert found(spark, rows, shard_turns=shard_turns) == expected


def test_closes_against_a_stack():
    draw = np.random.default_rng(3)
    for n in (1, 5, 40, 3000):
        bits, depth = [], 0
        while len(bits) + depth < 2 * n:
            up = depth == 0 or draw.random() < (0.5 if n < 3000 else 0.52)
            bits.append(up)
            depth += 1 if up else -1
        bits += [False] * depth
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert prefixes.Parentheses(np.array(bits)).closes(opens).tolist() == [close[i] for i in opens.tolist()]


def test_shards_merge_to_one_trie():
    draw = random.Random(2)
    sequences = sorted({tuple((draw.randint(0, 2), 0, 3) for _ in range(draw.randint(0, 6))) for _ in range(200)})
    own = [(list(s), draw.randint(1, 3), i, f"{i}") for i, s in enumerate(sequences)]
    figures = ("n_convs", "n_children", "n_leaves", "saved_tokens")

    def nodes(parts):
        out = {}
        for k, part in enumerate(parts):
            rows = prefixes.shard_nodes(part, parts[k - 1][-1][0] if k else None, parts[k + 1][0][0] if k + 1 < len(parts) else None)
            for i, key in enumerate(rows["node"]):
                old = out.get(key, (0,) * 4)
                assert key not in out or rows["spine"][i]
                out[key] = tuple(o + int(rows[c][i]) for o, c in zip(old, figures))
        return out

    whole = nodes([own])
    for size in (1, 2, 7, 50):
        assert nodes([own[i:i + size] for i in range(0, len(own), size)]) == whole


def test_empty_table_nulls_and_clashing_names(spark, rows):
    table = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (7, 3, "a", "b")],
                                  "conv_id long, turn long, role string, text string")
    more = table.withColumn("place", F.lit("x")).withColumn("a", F.lit(1)).withColumn("n", F.lit(None))
    assert sorted(map(tuple, prefixes.prefix_trie(more).collect()), key=str) == sorted(
        by_hand([tuple(r) for r in table.collect()]), key=str)
    assert prefixes.prefix_trie(table.limit(0)).count() == 0
    only = [(2, None, None, "t")]  # its first turns come from a conversation that is not there
    assert found(spark, only) == by_hand(only)
