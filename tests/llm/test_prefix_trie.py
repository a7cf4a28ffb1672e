"""The conversation trie against plain dictionaries of prefixes, with shards of a few rows."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest

from tallyloom.llm import prefix_trie
from tallyloom.llm.prefix_trie import conversation_turns, op12_conversation_prefix_trie, rebuilt, trie

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - int(math.fmod(c, 20)), [])[: heads[c]] + turns[heads[c] :] for c, turns in own.items()}


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[p] for p in below) if below else 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[p] for p in below)
    rows = []
    for path, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        rows.append((min(held), len(path), parent, len(held), len(children.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def nodes(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture
def table(spark):
    schema = "conv_id long, turn long, role string, text string, depth long, path string, key binary"
    return lambda rows: spark.createDataFrame([(*r, 1, "x", b"y") for r in rows], schema).repartition(3)


def conversations(rnd, n, texts):
    rows = [(c, t, rnd.choice(["user", "bot", None]), rnd.choice(texts)) for c in range(n) for t in range(rnd.randrange(1, 6))]
    same = [(5000 + c, t, "user", "hello there you") for c in range(40) for t in range(3)]
    long = [(c, t, "user", f"turn {t % 7}") for c in (7001, 7002, 7003) for t in range(60 if c < 7003 else 45)]
    odd = [(8000, None, None, None), (8000, 1, "", ""), (8001, 5, "u", "a b \t c\nd"), (8001, None, "u", "first"), (-7, 1, "user", "minus"), (None, 1, "user", "lost"), (8002, 1, "u", "x" * 100_000)]
    rows = rows + same + long + odd
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_rows", [20_000, 9, 1])
def test_trie_equals_dictionaries(table, shard_rows):
    rnd = random.Random(shard_rows)
    rows = conversations(rnd, 60 if shard_rows > 1 else 12, ["a b", "c", "", None, "d  e f"])
    expected = plain_trie(plain_rebuilt(rows))
    assert nodes(trie(rebuilt(conversation_turns(table(rows))), shard_rows)) == expected


def test_turnless_conversations_and_empty_table(spark, table):
    turns = conversation_turns(table([(20, 1, "u", "base one"), (20, 2, "u", "two")]))
    none = turns.selectExpr("conv_id + 1 AS conv_id", "slice(turns, 1, 0) AS turns")
    assert nodes(trie(turns.union(none), 1)) == plain_trie({20: [("u", "base one"), ("u", "two")], 21: []})
    assert trie(turns.where("false")).count() == 0


def test_op12_equals_sql(spark, small):
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
        found = connection.execute(prefix_trie.SQL)
        names = [c[0] for c in found.description]
        expected = sorted((tuple(dict(zip(names, row))[c] for c in COLUMNS) for row in found.fetchall()), key=str)
    assert nodes(op12_conversation_prefix_trie(spark, small)) == expected
