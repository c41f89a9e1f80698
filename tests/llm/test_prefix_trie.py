import hashlib
import random
import zlib
from collections import defaultdict

import parity
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import prefix_trie
from shopgrain.llm.prefix_trie import turn_lists, trie
from shopgrain.llm.trie_queries import OP13_SQL, op13_prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(convs):
    """Nodes of {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += p not in kids
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(p))
        digest = hashlib.sha256(ends.encode()).hexdigest()
        above = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), above, len(m), kids.get(p, 0), leaves[p], saved[p], digest))
    return sorted(out, key=repr)


def rebuilt(rows):
    """Conversations of (conv_id, turn, role, text) rows, led by the first of their hundred."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, tie, (role, text)))
    turns = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + mine[h:]
    return out


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, depth int")


ODD = (
    [(c, t, "user" if t % 2 else "assistant", f"turn {t} {'x' if c % 3 else 'É'}") for c in range(230) for t in range(c % 9)]
    + [(7, None, None, None), (7, None, "", ""), (7, 3, "user", ""), (7, 3, "a", "tie"), (7, 3, "a", "tie"), (7, 3, None, "a tie")]
    + [(None, 1, "user", "nobody's"), (412, 0, "user", "no first one"), (300, 0, "user", "lead"), (399, 0, "user", "other")]
    + [(500, t, "user", "again") for t in range(100)]
    + [(501 + c, t, "user", "again") for c in range(12) for t in range(90 + c % 4)]
    + [(600, 0, "user", "long " * 50_000), (601, 0, "user", "long " * 50_000)]
)


@pytest.mark.parametrize("shard", [500_000, 40])
def test_odd_rows(spark, tmp_path, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard)
    table(spark, ODD).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    assert rows_of(op13_prefix_trie(spark, str(tmp_path))) == brute(rebuilt(ODD))


def test_few_rows(spark, tmp_path):
    for name, rows in {"none": [], "null": ODD[-3:-2] * 2 + [(None, 0, "a", "b")], "lone": [(3, 0, "u", "t")]}.items():
        table(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        assert rows_of(op13_prefix_trie(spark, f"{tmp_path}/{name}")) == brute(rebuilt(rows))


@pytest.mark.parametrize("seed", range(3))
def test_random_lists_over_many_shards(spark, monkeypatch, seed):
    """Hot beginnings, many equal and many empty conversations, prefixes of each other, deep ones."""
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 60)
    pick = random.Random(seed)
    deep = [("u", pick.choice("ab")) for _ in range(70)]
    convs = {}
    for c in range(300):
        kind = pick.random()
        if kind < 0.3:
            convs[c] = deep[: pick.choice([0, 31, 32, 33, 64, 70])]
        elif kind < 0.6:
            convs[c] = [("u", "hot"), ("a", "hot")]
        else:
            convs[c] = [("u", pick.choice(["hot", "b", "ccc"])) for _ in range(pick.randrange(7))]
    rows = [(c, t, *turn) for c, turns in convs.items() for t, turn in enumerate(turns)]
    lists = turn_lists(table(spark, rows))
    bare = spark.createDataFrame([(c,) for c, t in convs.items() if not t], "conv_id long")
    lists = lists.unionByName(bare.withColumn("turns", F.array().cast(lists.schema["turns"].dataType)))
    assert rows_of(trie(lists)) == brute(convs)


def test_against_sql(spark, sf_dir):
    assert parity.compare(op13_prefix_trie(spark, sf_dir), parity.connect(sf_dir), OP13_SQL) is None
