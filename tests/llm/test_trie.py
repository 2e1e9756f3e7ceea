"""The prefix trie against a trie of dictionaries, with shards of any size."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import trie

NAMES = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(conversations):
    """Nodes of {id: list of (role, text)} by walking every conversation."""
    members, ends = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].split()) if node else 0
        saved[node] = own + sum(saved[c] for c in below)
    return {(min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])),
             leaves[node], saved[node], hashlib.sha256(
                 ",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
            for node, m in members.items()}


def as_rows(conversations):
    return [(c, t, *turn) for c, turns in conversations.items() for t, turn in enumerate(turns)]


def nodes_of(spark, conversations, extra=()):
    paths = trie.conversation_paths(spark.createDataFrame(as_rows(conversations), NAMES).repartition(3))
    turnless = [(c, b"") for c, turns in conversations.items() if not turns]
    if turnless:
        paths = paths.unionByName(spark.createDataFrame(turnless, "conv_id long, path binary"))
    found = [tuple(r) for r in trie.prefix_trie(paths).select(*COLUMNS).collect()]
    assert len(found) == len(set(found))
    return set(found)


def random_conversations(seed):
    rng = random.Random(seed)
    turns = [(role, text) for role in ("user", "assistant", "") for text in ("", "a b", "hello there you", "東 京")]
    found = {}
    for c in rng.sample(range(10_000), 150):
        if found and rng.random() < 0.5:  # a copy, a start or a continuation of another
            of = rng.choice(list(found.values()))
            found[c] = of[:rng.randint(0, len(of))] + [rng.choice(turns) for _ in range(rng.choice([0, 0, 1, 12]))]
        else:
            found[c] = [rng.choice(turns) for _ in range(rng.choice([0, 1, 2, 3, 8, 9, 17]))]
    return found


@pytest.mark.parametrize("cells", [1 << 19, 400, 40, 7])
def test_equals_a_trie_of_dictionaries_in_any_number_of_shards(spark, monkeypatch, cells):
    monkeypatch.setattr(trie, "SHARD_CELLS", cells)
    conversations = random_conversations(cells)
    assert nodes_of(spark, conversations) == plain(conversations)


def test_a_hot_conversation_and_its_continuations_span_shards(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_CELLS", 60)
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    common = [("user", "same first turn"), ("assistant", "same answer here")]
    conversations = {c: list(common) for c in range(300)}
    conversations |= {1000 + c: common + [("user", f"more {c % 5}")] * (c % 4) for c in range(60)}
    conversations |= {2000 + c: common[:1] for c in range(40)}
    assert nodes_of(spark, conversations) == plain(conversations)


def test_shared_nodes_too_many_for_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_CELLS", 50)
    monkeypatch.setattr("plumbline.operators.groups.BROADCAST_BYTES", 0)
    conversations = random_conversations(5)
    assert nodes_of(spark, conversations) == plain(conversations)


def test_a_very_long_conversation_beside_short_ones(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_CELLS", 2000)
    conversations = {c: [("user", "hi"), ("assistant", f"{c}")] for c in range(50)}
    conversations[7] = [("user", "hi")] * 3000
    conversations[8] = [("user", "hi")] * 2999 + [("user", "bye now")]
    conversations[9] = [("user", "word " * 100_000)]
    assert nodes_of(spark, conversations) == plain(conversations)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "assistant", "y"), (1, 0, "user", "x"),
            (2, -5, "", ""), (2, 3, "assistant", "y"), (2, 4, "user", "x"), (2, 5, "user", "x"),
            (None, 0, "user", "nobody's")]
    turns = spark.createDataFrame(rows, NAMES)
    for name in ("path", "Step", "steps", "record", "depth", "shard"):
        turns = turns.withColumn(name, F.lit(1))
    paths = trie.conversation_paths(turns)
    same = [("", ""), ("assistant", "y"), ("user", "x"), ("user", "x")]
    assert {tuple(r) for r in trie.prefix_trie(paths.withColumn("Depth", F.lit(2))).select(*COLUMNS).collect()} \
        == plain({1: same, 2: same})


def test_empty_table_and_roles_are_told_from_texts(spark):
    assert nodes_of(spark, {}) == set()
    assert trie.prefix_trie(trie.conversation_paths(spark.createDataFrame([], NAMES))).count() == 0
    conversations = {1: [("ab", "c")], 2: [("a", "bc")], 3: [("", "abc")], 4: []}
    assert nodes_of(spark, conversations) == plain(conversations)


def test_turn_ids_lead_back_to_the_turn(spark):
    conversations = random_conversations(3)
    turns = spark.createDataFrame(as_rows(conversations), NAMES)
    nodes = trie.prefix_trie(trie.conversation_paths(turns))
    assert nodes.where((F.col("depth") > 0) & (F.octet_length("turn_id") != 16)).count() == 0
    one = trie.conversation_paths(spark.createDataFrame([(1, 0, "user", "a b")], NAMES)).first()["path"]
    wanted = sum(turns[0] == ("user", "a b") for turns in {
        tuple(t[:1]): t for t in conversations.values() if t}.values())
    assert nodes.where((F.col("depth") == 1) & (F.col("turn_id") == F.lit(bytes(one[:16])))).count() == wanted
