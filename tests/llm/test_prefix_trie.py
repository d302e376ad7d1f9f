"""The prefix trie against a trie of plain Python sequences."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from plantlens.llm import prefix_trie
from plantlens.llm.common import table
from plantlens.llm.queries import LLM_QUERIES

DDL = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def in_order(rows):
    spoken = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            spoken[conv_id].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    return {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in spoken.items()}


def with_heads(spoken):
    out = {}
    for c, own in spoken.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c - 5 * int(c / 5))
        out[c] = spoken.get(base, [])[:h] + own[h:]
    return out


def plain(spoken):
    members = defaultdict(list)
    for c in sorted(spoken):
        for d in range(len(spoken[c]) + 1):
            members[tuple(spoken[c][:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        n_bytes = len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = (len(members[path]) - 1) * n_bytes + sum(saved[c] for c in children[path])
        ended = ",".join(str(c) for c in members[path] if len(spoken[c]) == len(path))
        out.append((
            members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]),
            len(children[path]), leaves[path], saved[path], hashlib.sha256(ended.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def answer(convs_and_steps):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(*convs_and_steps).collect()), key=str)


def ordered(spark, rows):
    return prefix_trie.turns_in_order(spark.createDataFrame(rows, DDL))


def random_rows(seed, n=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in range(-3, n):
        if rng.random() < 0.15:
            continue
        stem = [("user", f"q{rng.randrange(2)}"), ("assistant", "é" * rng.randrange(3))]
        turns = stem + [(rng.choice(["user", None]), rng.choice(["a", "b", None, ""])) for _ in range(rng.randrange(longest))]
        if rng.random() < 0.3:
            turns = [("user", "the same")] * 5
        rows += [(c, i if rng.random() < 0.9 else rng.choice([None, i, 3]), r, t) for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rows = random_rows(seed)
    spoken = in_order(rows)
    assert answer(prefix_trie.as_they_are(ordered(spark, rows))) == plain(spoken)
    assert answer(prefix_trie.rebuilt(ordered(spark, rows), 5, 9)) == plain(with_heads(spoken))


@pytest.mark.parametrize("block, least, entries, ids, broadcast", [(3, 4, 5, 2, -1), (2, 1, 1, 1, 1 << 20), (5, 20, 3, 1000, -1)])
def test_small_blocks_shards_and_queues(spark, monkeypatch, block, least, entries, ids, broadcast):
    """Every bound is passed: blocks of few turns, many heavy nodes, spilling queues, ids in pieces."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "LEAST_SHARD", least)
    monkeypatch.setattr(prefix_trie, "HEAVY_SHARE", 10_000)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", ids)
    monkeypatch.setattr(prefix_trie, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(prefix_trie.forward, "__defaults__", (entries,))
    rows = random_rows(7, 80)
    spoken = in_order(rows)
    assert answer(prefix_trie.rebuilt(ordered(spark, rows), 5, 9)) == plain(with_heads(spoken))


def test_one_long_conversation_and_copies(spark, monkeypatch):
    """A conversation with most turns, a copy of it, and a thousand equal short ones."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 64)
    rows = [(c, i, "user", f"t{i}") for c in (1, 2) for i in range(700)]
    rows += [(c, i, "user", f"s{i}") for c in range(10, 510) for i in range(2)]
    spoken = in_order(rows)
    assert answer(prefix_trie.as_they_are(ordered(spark, rows))) == plain(spoken)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = LLM_QUERIES["op13_prefix_trie"].run(spark, sf_dir)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=str) == plain(with_heads(in_order(rows)))


def test_edges(spark):
    assert answer(prefix_trie.rebuilt(ordered(spark, []), 5, 9)) == []
    assert answer(prefix_trie.as_they_are(ordered(spark, [(None, 1, "user", "x")]))) == []
    rows = [(4, None, None, None), (4, None, None, None), (None, 1, "user", "x")]
    assert answer(prefix_trie.as_they_are(ordered(spark, rows))) == plain(in_order(rows))
    # Roles and texts that look alike only when put together are different turns.
    rows = [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "", "abc")]
    assert len(answer(prefix_trie.as_they_are(ordered(spark, rows)))) == 4
    # Longer than any number of characters that one task would look at, and other columns.
    rows = [(1, 0, "user", "x" * 3_000_000, 5), (2, 0, "user", "x" * 3_000_000, 6)]
    df = spark.createDataFrame(rows, DDL + ", depth long")
    found = answer(prefix_trie.as_they_are(prefix_trie.turns_in_order(df)))
    assert [r[6] for r in found] == [3_000_000, 3_000_000]


def test_queue_spills():
    queue, plain_heap = prefix_trie.SpillingQueue(7), []
    rng = random.Random(1)
    for _ in range(200):
        item = (rng.randrange(30), rng.randrange(5))
        queue.push(item)
        plain_heap.append(item)
    assert len(queue.heap) <= 7 and len(queue.runs) > 20
    for key in range(30):
        assert sorted(queue.take((key,))) == sorted(i for i in plain_heap if i[0] == key)
