import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_fixtures import words
from pyspark.sql import functions as F

from riskweave.llm import burst_trie as b
from riskweave.session import cut_lineage

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(turns, key=lambda x: x)] for c, turns in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(rows):
    paths = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []

    def walk(node):
        own = (len(members[node]) - 1) * (len(words(node[-1][1])) if node else 0)
        below = [walk(x) for x in children[node]]
        leaves, saved = sum(x[0] for x in below) or 1, own + sum(x[1] for x in below)
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves, saved, sha))
        return leaves, saved

    if members:
        walk(())
    return sorted(out, key=str)


def tried(spark, rows, limit, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    placed = cut_lineage(b.positions(df))
    found = b.trie(*b.with_shared_heads(placed), limit=limit)
    assert found.columns == b.VALUES
    return sorted(map(tuple, found.collect()), key=str)


def random_conversations(seed=3):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-30, 60), 2**40]:
        for t in range(rng.choice([0, 1, 2, 3, 5])):
            rows.append((c, rng.choice([t, t, None, 1]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "a b", None, "", " x  y "])))
    return rows


@pytest.mark.parametrize("limit", [1, 12, 4096])
def test_equals_brute_force(spark, limit):
    rows = random_conversations() + [(None, 1, "user", "nobody's")]
    assert tried(spark, rows, limit) == brute(rows)


def test_long_and_common_conversations(spark, monkeypatch):
    monkeypatch.setattr(b, "COPIES", 16)
    rows = [(c, t, "user", "the same words") for c in range(600, 640) for t in range(9)]  # many copies, burst again and again
    rows += [(500, t, "user", f"turn {t}") for t in range(200)]  # one long chain above any container
    rows += [(501, 1, "user", "again")] * 100  # one row many times
    assert tried(spark, rows, 30) == brute(rows)


def test_containers_are_bounded(spark):
    rows = random_conversations(5) + [(c, t, "user", "same") for c in range(700, 760) for t in range(5)]
    placed = cut_lineage(b.positions(spark.createDataFrame(rows, SCHEMA)))
    _, paths = b.with_shared_heads(placed)
    heads, contained = b.burst(cut_lineage(b.with_heads(paths)), 20)
    sizes = [r["count"] for r in contained.groupBy("top", "box_0", "box_1").count().collect()]
    assert sizes and max(sizes) <= 20
    assert heads.count() + contained.count() == paths.count()


def test_sweep_of_one_container():
    paths = [(("a", "b"), 4, (1, 2)), (("a",), 2, (1,)), (("a", "c", "d"), 3, (1, 1, 5)), (("a", "b"), 1, (1, 2))]
    found = {(r[1], r[0]): r[2:7] for r in b.sweep(paths, 3)}
    # parent, members, children, leaves, saved words
    assert found == {(3, 1): [None, 4, 2, 2, 3 + 2], (4, 1): [1, 2, 0, 1, 2], (4, 3): [1, 1, 1, 1, 0], (5, 3): [3, 1, 0, 1, 0]}


def test_nothing_and_turnless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert b.trie(*b.with_shared_heads(cut_lineage(b.positions(empty)))).collect() == []
    # conversations whose own turns all give way to an absent head are members of the root alone
    lonely = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20][:5]
    rows = [(c, 0, "user", "gone") for c in lonely]
    assert tried(spark, rows, 4096) == brute(rows)
    assert len(brute(rows)) == 1


def test_other_columns_with_clashing_names(spark):
    rows = random_conversations(7)
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("n", "place", "depth", "words", "total", "turn_id", "slice_no", "head_0", "copy", "stretch")])
    found = b.trie(*b.with_shared_heads(cut_lineage(b.positions(df))))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
