"""The prefix trie next to one made of plain prefixes."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from patronage.llm import turn_tries
from patronage.llm.registry import op13_turn_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = tuple(own.get(donor, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, ids in members.items():
        words = len([w for w in re.split("[\x20\x09-\x0d]+", p[-1][1]) if w]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(ids) - 1) * words
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (
            (min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), children[p], leaves[p], saved[p], digest(ends.get(p, [])))
            for p, ids in members.items()
        ),
        key=repr,
    )


def found(turns):
    return sorted((tuple(r) for r in turn_tries.trie(turns).nodes.select(*COLUMNS).collect()), key=repr)


def talks(n, seed):
    """Conversations over few turns, so that they share prefixes, with many copies of one."""
    rng = random.Random(seed)
    pool = [f"turn {i} " * (i % 4) for i in range(6)]
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((c * 7 % (3 * n), t, rng.choice(["user", "assistant"]), rng.choice(pool)))
    rows += [(5000 + c, t, "user", "always the same") for c in range(n) for t in range(4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns, part_ids", [(100_000, 5_000), (40, 3), (1, 1)])
def test_equals_plain_prefixes(spark, monkeypatch, shard_turns, part_ids):
    monkeypatch.setattr(turn_tries, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(turn_tries, "PART_IDS", part_ids)
    rows = talks(80, shard_turns)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (1, None, None, None), (1, 2, "user", "a"), (1, 2, "user", "a"), (1, 2, "user", "A"),
        (20, 0, "user", "x y"), (21, 0, "user", "x y"), (22, 0, "user", "short"), (23, 0, "", ""), (-3, 0, "user", "minus"),
        (0, 0, "user", "zero"), (40, 0, "user", "w " * 50_000), (41, 5, "user", "é ü"), (42, -5, "a", "b"), (42, None, "c", "d"),
        *[(60, t, "user", f"t{t % 3}") for t in range(1500)], *[(61, t, "user", f"t{t % 3}") for t in range(1400)],
    ]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_no_rows_and_clashing_names(spark):
    rows = talks(20, 9)
    turns = spark.createDataFrame(rows, SCHEMA)
    clash = turns.selectExpr("*", "1 AS conv", "2 AS code", "'k' AS key", "3 AS words", "4 AS depth", "5 AS shard", "6 AS h")
    assert found(clash) == found(turns) == plain(rows)
    assert found(turns.where("conv_id < -99")) == []
    renamed = turns.withColumnsRenamed({"conv_id": "c", "turn": "t", "role": "key", "text": "words"})
    assert turn_tries.trie(renamed, "c", "t", "key", "words").nodes.count() == len(plain(rows))


def test_nodes_name_their_turns(spark):
    rows = talks(15, 3)
    made = turn_tries.trie(spark.createDataFrame(rows, SCHEMA))
    named = made.nodes.join(made.dictionary, "code", "left").select("depth", "role", "text").collect()
    assert all((r.role is None) == (r.depth == 0) for r in named)
    assert {(r.role, r.text) for r in named if r.depth} <= {(r[2], r[3]) for r in rows}


def test_trie_is_balanced_by_medians():
    rows = [([i], [1], i, 1, "d") for i in range(1023)]
    trie = turn_tries.ShardTrie(rows)
    deepest, pending = 0, [(trie.down[0], 1)]
    while pending:
        node, depth = pending.pop()
        if node:
            deepest = max(deepest, depth)
            pending += [(trie.low[node], depth + 1), (trie.high[node], depth + 1)]
    assert deepest == 10


def test_query_keeps_the_contract(spark):
    columns = op13_turn_trie(spark, "/root/testdata/sf0.001").columns
    assert sorted(columns) == sorted(COLUMNS)
