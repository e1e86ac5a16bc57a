import hashlib
import random
import zlib
from collections import defaultdict
from math import fmod

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clinspark.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"


def expected(rows):
    """Every prefix of every rebuilt conversation, one by one."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv_id].append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [t for _, t in sorted(found)] for c, found in turns.items()}
    members = defaultdict(list)
    rebuilt = {}
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(turns.get(c - int(fmod(c, 100)), [])[:h] + turns[c][h:])
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found, totals = [], {}
    for node in sorted(members, key=lambda n: -len(n)):
        below = [totals[child] for child in children[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
        ends = ",".join(str(c) for c in members[node] if rebuilt[c] == node)
        found.append(
            (
                members[node][0],
                len(node),
                members[node[:-1]][0] if node else None,
                len(members[node]),
                len(children[node]),
                *totals[node],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def found(frame, **options):
    return sorted(map(tuple, prefix_trie.trie(frame, **options).collect()), key=str)


def rows_with_copies(seed, n=260):
    """Conversations of few distinct turns, so that many share their beginnings."""
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(0, 500), n):
        for turn in range(pick.randrange(1, 9)):
            rows.append((c, turn, pick.choice(["user", "assistant"]), pick.choice(["hello", "yes", "no ü🙂"])))
    return rows


@pytest.mark.parametrize("light, limit", [(1, 3), (4, 100_000), (1000, 5)])
def test_shared_beginnings(spark, light, limit):
    rows = rows_with_copies(light)
    assert found(spark.createDataFrame(rows, TURNS), light=light, queue_limit=limit) == expected(rows)


def test_nulls_ties_repeated_rows_and_turnless(spark):
    rows = [
        (200, None, "user", "first"),
        (200, 1, None, "a"),
        (200, 1, "user", None),
        (200, 1, "user", None),
        (201, 5, "user", "x"),
        (202, 0, "user", ""),
        (100, -3, "", ""),
        (7, 0, "user", "no base"),
        (-5, 0, "user", "below zero"),
        (-150, 2, "user", "below zero"),
        (None, 0, "user", "no id"),
    ]
    rows += [(201, i, "user", f"t{i}") for i in range(10)] + [(300 + c, 0, "u", "lone") for c in range(1, 90)]
    assert found(spark.createDataFrame(rows, TURNS)) == expected(rows)


def test_one_conversation_with_a_third_of_all_turns(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 4)
    rows = [(400, i, "user", f"turn {i % 7}") for i in range(700)]
    rows += [(400 + c, i, "user", f"turn {i % 7}") for c in range(1, 100) for i in range(c % 8 + 6)]
    assert found(spark.createDataFrame(rows, TURNS).repartition(8), light=8) == expected(rows)


def test_many_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    rows = [(1000 + c, i, "user", "same") for c in range(700) for i in range(8)]
    assert found(spark.createDataFrame(rows, TURNS), light=16) == expected(rows)


def test_other_columns_and_empty_table(spark):
    frame = spark.createDataFrame(
        [(1, 0, "user", "a", "k", 9), (2, 0, "user", "a", "k", 9)], TURNS + ", key string, depth int"
    )
    assert found(frame) == expected([(1, 0, "user", "a"), (2, 0, "user", "a")])
    assert found(frame.where("false")) == []


def test_whole_table(spark):
    frame = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert found(frame) == expected(map(tuple, frame.collect()))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=200), st.integers(1, 10))
def test_queue_returns_messages_in_order(messages, limit):
    queue = prefix_trie.SpillingQueue(limit)
    for place, value in messages:
        queue.push((place, value))
        assert len(queue.heap) <= limit
    for place in range(6):
        assert sorted(v for (v,) in queue.take((place,))) == sorted(v for p, v in messages if p == place)
    assert len(queue) == 0
