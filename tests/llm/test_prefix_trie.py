"""Nodes against brute force, for shards of every size; the queue against sorting."""

import hashlib
import random
import zlib

import compare
import pytest

from pulsepanel.llm import prefix_trie, registry


def brute(rows):
    """Rows as the operator returns them, from (conv_id, turn, role, text)."""

    def key(role, text):
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()

    convs = {}
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role.encode(), key(role, text), role, text))
    convs = {c: [t[4:] for t in sorted(turns)] for c, turns in convs.items()}
    nodes = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        turns = convs.get(base, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            node = nodes.setdefault(tuple(turns[:d]), {"all": [], "end": [], "leaves": 0, "saved": 0, "children": 0})
            node["all"].append(c)
            if d == len(turns):
                node["end"].append(c)
    for turns, node in nodes.items():
        if turns:
            nodes[turns[:-1]]["children"] += 1
    for turns, node in nodes.items():
        for d in range(len(turns) + 1):
            up = nodes[turns[:d]]
            up["leaves"] += node["children"] == 0
            up["saved"] += (len(node["all"]) - 1) * (len(turns[-1][1]) if turns else 0)
    return sorted(
        (
            min(n["all"]), len(t), min(nodes[t[:-1]]["all"]) if t else -(10**18), len(n["all"]), n["children"],
            n["leaves"], n["saved"], hashlib.sha256(",".join(map(str, sorted(n["end"]))).encode()).hexdigest(),
        )
        for t, n in nodes.items()
    )


def rows_of(df):
    assert df.columns == prefix_trie.RESULT
    return sorted(tuple(-(10**18) if v is None else v for v in r) for r in df.collect())


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def talks(seed=1, convs=160):
    r = random.Random(seed)
    says = ["", "hi", "é☃ \U0001f600", "a longer text " * 5, None]
    rows = []
    for c in r.sample(range(-250, 700), convs):
        if r.random() < 0.3:  # copies of one long conversation
            rows += [(c, i, "user", f"copied {i}") for i in range(30)]
        for i in range(r.choice([1, 2, 7, 20])):
            row = (c, r.choice([i, i, 3, None]), r.choice(["user", "assistant", None]), r.choice(says))
            rows += [row] * r.choice([1, 1, 2])
    rows += [(100, i, "user", "hi") for i in range(400)] + [(None, 1, "user", "no id"), (7, None, None, None)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [7, 60, 900, 1 << 40])
def test_against_brute_force(spark, shard_turns):
    rows = talks()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "'x' AS path", "1 AS depth", "2 AS a")
    assert rows_of(prefix_trie.prefix_trie(table, shard_turns)) == brute(rows)


def test_hot_conversation_in_small_shards(spark):
    rows = [(c, i, "user", f"t{i}") for c in range(300) for i in range(4)]
    rows += [(1000 + c, i, "user", f"{c} {i}") for c in range(100) for i in range(3)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert len(prefix_trie.split_points(prefix_trie.rebuilt_turns(table), 50)) > 10
    assert rows_of(prefix_trie.prefix_trie(table, 50)) == brute(rows)


def test_few_or_no_conversations(spark):
    table = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert prefix_trie.prefix_trie(table).collect() == []
    # 5 takes more turns than it has from a conversation that isn't there: turnless
    assert zlib.crc32(b"5") % 6 > 1
    rows = [(5, 0, "user", "x")]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert len(brute(rows)) == 1


def test_queue_gives_messages_in_order():
    r = random.Random(2)
    for _ in range(50):
        queue, held = prefix_trie.SpillingQueue(most=8, block=3), []
        for _ in range(300):
            if held and r.random() < 0.45:
                held.sort()
                assert queue.first() == held[0] == queue.pop()
                held.pop(0)
            else:
                held.append((r.randrange(100), r.random()))
                queue.push(held[-1])
        assert queue.spilled > 0
        assert [queue.pop() for _ in held] == sorted(held) and queue.first() is None


def test_spilling_changes_nothing():
    # states in order: 40 leaves below 4 nodes below one
    states = [(False, None, 3, i, 0, i % 4, 0, i, 5, 1, 0, 0, 0, True) for i in range(40)]
    states += [(False, None, 2, p, 0, 0, 0, c, 2, 1, 0, 0, 0, False) for p in range(4) for c in range(p, 40, 4)]
    states += [(False, None, 1, 0, 0, 0, 0, c, 3, 1, 0, 0, 0, False) for c in range(40)]
    found = [list(prefix_trie.time_forward(iter(states), queued=most)) for most in (1000, 4)]
    assert found[0] == found[1] and len(found[0]) == 45
    top = found[0][-1]
    assert top[9:13] == (40, 4, 40, 4 * 9 * 2 + 39 * 3)


def test_query_equals_sql(spark, sf_dir):
    name = "op12_prefix_trie"
    for sf in (sf_dir, "/root/testdata/sf0.01"):
        duck = compare.connect(sf)
        assert compare.differences(spark, duck, registry.QUERIES[name], registry.SQL[name], sf)[0] == []
