"""The z-fast trie of conversations against one built turn by turn."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import prefix_trie
from tidemark.llm.prefix_trie import conversation_trie, fattest

SHAPE = "conv_id long, turn long, role string, text string"


def mark(role, text):
    framed = "".join(f"{len(x.encode())}:{x}" for x in (role, text))
    return hashlib.sha256(framed.encode()).hexdigest()[:32]


def brute(table):
    given = {}
    for c, turn, role, text in table:
        if c is not None:
            given.setdefault(c, []).append((turn is not None, turn or 0, mark(role or "", text or ""), role or "", text or ""))
    if not given:
        return []
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in given.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    nodes = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            node = nodes.setdefault(tuple(ts[:d]), {"members": [], "ends": [], "children": set()})
            node["members"].append(c)
            if d == len(ts):
                node["ends"].append(c)
            if d:
                nodes[tuple(ts[:d - 1])]["children"].add(tuple(ts[:d]))
    leaves, saved = {}, {}
    for key in sorted(nodes, key=len, reverse=True):
        node = nodes[key]
        own = (len(node["members"]) - 1) * len(key[-1][1]) if key else 0
        leaves[key] = sum(leaves[k] for k in node["children"]) or 1
        saved[key] = own + sum(saved[k] for k in node["children"])
    return sorted(((min(n["members"]), len(k), min(nodes[k[:-1]]["members"]) if k else None, len(n["members"]), len(n["children"]),
                    leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest())
                   for k, n in nodes.items()), key=repr)


def held(spark, values):
    assert rows(conversation_trie(spark.createDataFrame(values, SHAPE))) == brute(values)


def draw(seed, convs, turns, words, span=400):
    rnd = random.Random(seed)
    found = []
    for c in rnd.sample(range(-span, span), convs):
        for i in range(rnd.randint(1, turns)):
            found.append((c, rnd.choice([i, i, i, None]), rnd.choice(["user", "bot", None]), rnd.choice(words)))
    rnd.shuffle(found)
    return found


@pytest.mark.parametrize("seed, convs, turns, words", [
    (1, 40, 9, ["a", "b", None, ""]), (2, 300, 5, ["x", "yé"]), (3, 25, 60, ["same"])])
def test_random_conversations(spark, seed, convs, turns, words):
    held(spark, draw(seed, convs, turns, words))


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, name):
    table = spark.read.parquet(f"/root/testdata/{name}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = table.withColumns({c: F.lit("x") for c in ("conv", "depth", "path", "name", "pos", "size", "lo", "hi", "n", "parent")})
    assert rows(conversation_trie(odd)) == brute([tuple(r) for r in table.collect()])


def test_odd_tables(spark):
    held(spark, [])
    held(spark, [(None, 0, "user", "lost")])
    held(spark, [(None, 0, "user", "lost"), (7, None, None, None), (7, None, None, None), (7, 0, "user", "x" * 500_000)])
    # Turnless ones: too few turns of their own and no base.
    turnless = [c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 == 5][:4]
    held(spark, [(c, 0, "user", "t") for c in turnless])
    held(spark, [(c, 0, "user", "t") for c in turnless] + [(50_000, 0, "user", "t")])


def test_long_chains_and_many_copies(spark, monkeypatch):
    # Prefixes of every length of one conversation, branches along it, deeper than the keys carried along.
    monkeypatch.setattr(prefix_trie, "INLINE", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    values = [(100 * k, i, "user", "t" if i < k % 50 else f"{k}") for k in range(60) for i in range(k % 50 + k // 30)]
    values += [(100 * k, i, "user", "copy") for k in range(100, 250) for i in range(7)]
    held(spark, values)


def test_the_two_fattest_number(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)] + [(2**40 - 1, 2**40 + 5), (2**33, 2**33 + 1)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for r in got:
        near = range(r.a + 1, min(r.b, r.a + 50) + 1)
        assert r.f == max(near, key=lambda x: x & -x)


def test_plans_stay_small(spark, monkeypatch):
    """However long the strings, no table of the search is made by more than a few joins: the driver keeps every plan."""
    joins, write = {}, prefix_trie.written

    def counted(df, label, *options):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins[label] = max(joins.get(label, 0), plan.count("Join "))
        return write(df, label, *options)

    monkeypatch.setattr(prefix_trie, "written", counted)
    held(spark, [(c, t, "user", "same" if t < 30 + c else f"{c} {t}") for c in range(4) for t in range(60)])
    assert joins["trie-located"] <= 4, joins
