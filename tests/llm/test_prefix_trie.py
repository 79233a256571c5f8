import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from retail_lakehouse.llm import prefix_trie as pt
from retail_lakehouse.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """Straight from the definition, with whole sequences as nodes."""
    original = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            original[conv].append(((turn is not None, turn or 0), said, (role, text)))
    turns = {c: [t for *_, t in sorted(x)] for c, x in original.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        path = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        if node:
            children[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted((min(members[n]), len(n), min(members[n[:-1]]) if n else -1, len(members[n]), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n in members)


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def random_rows(seed, convs=120, most=9):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant", None]), r.choice(["hi", "hé", "", None, "good day"]))
            for c in r.sample(range(-150, 400), convs) for t in range(r.randint(1, most))]


@pytest.mark.parametrize("kw", [{}, dict(block=2, least_shard=1, limit=1), dict(block=3, least_shard=6, limit=2)])
def test_equals_brute_force(spark, kw):
    rows = random_rows(1)
    random.Random(2).shuffle(rows)
    assert found(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), **kw)) == brute_force(rows)


def test_long_conversations_and_groups_of_copies(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(200, 300) for t in range(4)]
    rows += [(c, t, "user", f"long {t}") for c in (7, 8, 9) for t in range(90)] + [(5, 0, "user", "first")]
    assert found(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), block=8, least_shard=10, limit=3)) == brute_force(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", "lost"), (1, None, "user", "a"), (1, None, "user", "b"), (1, 0, None, None), (1, 0, None, None),
            (100, 3, "user", "x" * 100_000), (101, 3, "user", "y"), (102, None, None, "z"), (203, 0, "user", "no base")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(pt.prefix_trie(df)) == brute_force(rows)
    named = df.selectExpr("*", "1 as node", "2 as depth", "'p' as parent", "3 as _pos", "4 as base", "5 as n", "6 as last", "7 as chars")
    assert found(pt.prefix_trie(named)) == brute_force(rows)


def test_one_conversation_and_empty_table(spark):
    rows = [(0, t, "user", f"t{t}") for t in range(3)]
    assert found(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)
    assert found(pt.prefix_trie(spark.createDataFrame([], SCHEMA))) == []


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_prefix_trie(spark, sf)) == brute_force(rows)


def test_queue_spills_in_order():
    r = random.Random(3)
    messages = sorted((-r.randrange(4), bytes([r.randrange(3)]) * 16, r.randrange(9), r.randrange(9)) for _ in range(200))
    queue = pt.SpillingQueue(7)
    for m in r.sample(messages, len(messages)):
        queue.push(m)
    taken = [m for key in sorted({m[:2] for m in messages}) for m in queue.take(*key)]
    assert taken == messages and list(queue.take(0, pt.ROOT)) == []
