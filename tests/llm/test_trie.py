"""The trie of conversations against one built in memory."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from orestrata.llm import conversation_trie, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, n int"


def brute(paths):
    """Nodes of {conv_id: ((role, text), ...)} as rows of the result."""
    members = defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1]) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * size + sum(saved[c] for c in children[node])
    rows = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if paths[c] == node)
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def turns_of(paths):
    return [(conv, i, role, text, "x", 1) for conv, path in paths.items() for i, (role, text) in enumerate(path)]


@pytest.mark.parametrize("shards, most_turns", [(1, 64), (7, 64), (40, 64), (40, 2)])
def test_against_brute_force(spark, shards, most_turns):
    """A third of all conversations are copies of one, and most share their first turns."""
    random.seed(shards)
    said = [("user", "a"), ("user", "bé"), ("assistant", "a"), ("assistant", "long " * 9), ("user", "")]
    paths = {i: tuple(random.choices(said, [9, 2, 1, 1, 1])[0] for _ in range(random.randint(1, 7))) for i in range(-60, 300)}
    paths |= {i: (said[0], said[3], said[1]) for i in range(8000, 8180)}
    members = conversation_trie.turn_paths(spark.createDataFrame(turns_of(paths), SCHEMA))
    got = conversation_trie.prefix_trie(members, shards, most_turns)
    assert sorted(map(tuple, got.collect()), key=str) == brute(paths)


def test_many_members_of_one_path(spark):
    members = spark.range(20_000).selectExpr("id * 3 AS conv_id", "CASE WHEN id % 2 = 0 THEN unhex(repeat('AB', 20)) ELSE X'' END AS path")
    got = conversation_trie.prefix_trie(members, 4).collect()
    ids = [",".join(str(3 * i) for i in range(first, 20_000, 2)) for first in (0, 1)]
    assert {(r.depth, r.n_convs, r.ends_sha256) for r in got} == {
        (1, 10_000, hashlib.sha256(ids[0].encode()).hexdigest()), (0, 20_000, hashlib.sha256(ids[1].encode()).hexdigest())
    }


def test_order_of_turns_nulls_and_nothing(spark):
    rows = [
        (1, 2, "user", "c", None, None), (1, None, None, None, None, None), (1, 1, "user", "b", None, None),
        (2, 0, "", "", None, None), (2, 5, "user", "b", None, None), (2, 6, "user", "c", None, None), (2, 6, "user", "c", None, None),
        (None, 0, "user", "lost", None, None),
    ]
    turns = spark.createDataFrame(rows, SCHEMA)
    first = (("", ""), ("user", "b"), ("user", "c"))
    got = conversation_trie.prefix_trie(conversation_trie.turn_paths(turns))
    assert sorted(map(tuple, got.collect()), key=str) == brute({1: first, 2: (*first, ("user", "c"))})
    assert conversation_trie.prefix_trie(conversation_trie.turn_paths(turns.limit(0))).collect() == []


def test_role_and_text_are_kept_apart(spark):
    turns = spark.createDataFrame([(1, 0, "a", "bc", "", 0), (2, 0, "ab", "c", "", 0)], SCHEMA)
    assert conversation_trie.turn_paths(turns).select("path").distinct().count() == 2


def test_a_long_conversation_and_long_texts(spark):
    paths = {1: tuple(("user", str(i)) for i in range(700)), 2: tuple(("user", str(i)) for i in range(650)), 3: (("user", "é" * 200_000),)}
    got = conversation_trie.prefix_trie(conversation_trie.turn_paths(spark.createDataFrame(turns_of(paths), SCHEMA)), 5)
    assert sorted(map(tuple, got.collect()), key=str) == brute(paths)


def test_query(spark, tmp_path):
    """Openings come from the hundred's first conversation, if there is one."""
    random.seed(8)
    own = {c: tuple(("user", f"{c}.{i}") for i in range(random.randint(1, 8))) for c in [*range(0, 260), *range(500, 520)] if c != 100}
    spark.createDataFrame(turns_of(own), SCHEMA).drop("path", "n").write.parquet(f"{tmp_path}/conversations.parquet")
    rebuilt = {}
    for c, path in own.items():
        taken = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, ())[:taken] + path[taken:]
    assert any(not path for path in rebuilt.values())
    got = queries.op12_conversation_trie(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt)
