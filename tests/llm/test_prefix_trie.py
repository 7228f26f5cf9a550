import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from meteomart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(r[2], r[4]) for r in sorted(t)] for c, t in convs.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        own = tuple(turns.get(first, [])[:h]) + tuple(turns[c][h:])
        for d in range(len(own) + 1):
            members[own[:d]].add(c)
        ends[own].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        weight = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += weight
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def found(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                       "saved_tokens", "ends_sha256").collect()), key=str)


def rows_of(rng, convs):
    return [(c, rng.choice([None, t]), rng.choice(["user", "assistant", None]), rng.choice([None, "", "a", "bé", "long " * 9]))
            for c in convs for t in range(rng.randrange(12))]


def test_odd_rows_against_brute_force(spark):
    rng = random.Random(3)
    rows = rows_of(rng, [*range(-12, 60), 10_007, 2**40]) + [(None, 1, "user", "no conversation")]
    rows += rows[:9]                                     # repeated rows are turns of their own
    rows += [(300 + i, t, "user", "same") for i in range(40) for t in range(6)]       # one group of copies
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("k1", "depth", "path", "pos", "h", "n_turns", "part", "digest"):
        df = df.withColumn(name, F.lit("clash"))
    assert found(prefix_trie.nodes(df)) == sorted(by_hand(rows), key=str)


def test_deep_conversations_cross_blocks_and_bands(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    monkeypatch.setattr(prefix_trie, "BLOCK", 12)
    rng = random.Random(4)
    rows = [(c, t, "user", "x" if t < 9 * c else str(rng.randrange(2))) for c in range(7) for t in range(rng.choice([26, 27, 28, 81, 90]))]
    assert found(prefix_trie.nodes(spark.createDataFrame(rows, SCHEMA))) == sorted(by_hand(rows), key=str)


def test_one_conversation_of_many_turns(spark):
    rows = [(5, t, "user", "again") for t in range(1200)] + [(c, 0, "user", "again") for c in range(5, 10)]
    assert found(prefix_trie.nodes(spark.createDataFrame(rows, SCHEMA))) == sorted(by_hand(rows), key=str)


def test_heavy_parents_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HEAVY", 10)
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = rows_of(random.Random(5), range(50)) + [(c, 0, "user", "hi") for c in range(100, 180)]
    assert found(prefix_trie.nodes(spark.createDataFrame(rows, SCHEMA))) == sorted(by_hand(rows), key=str)


def test_empty_table(spark):
    assert prefix_trie.nodes(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_sql_twin(empty):
    rows = [] if empty else [r for r in rows_of(random.Random(6), range(-3, 30)) if r[1] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.sql(prefix_trie.ORACLE).fetchall(), key=str) == sorted(by_hand(rows), key=str)
