import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_fixtures import LOWER, frame, odd_rows, random_rows, words

from riskweave.llm import simhash as s
from riskweave.llm.tables import BATCH_BYTES, arrow_bytes, cut_lineage


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(bits):
    """The first place that each fingerprint reaches, by all pairs."""
    bits = np.array(bits, np.uint64)
    one, two = np.nonzero(np.bitwise_count(bits[:, None] ^ bits[None]) <= 4)
    return s.forest(len(bits), one, two)


def brute(rows):
    bits = [fingerprint(r[1]) for r in rows]
    root = groups(bits)
    out = []
    for i, row in enumerate(rows):
        ids = [r[0] for r, g in zip(rows, root, strict=True) if g == root[i] and r[0] is not None]
        out.append((row[0], f"{bits[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def near_fingerprints(n, seed=4):
    """Random fingerprints and, of some of them, many with a few bits changed; a share has equal bits in a block."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n // 2)]
    while len(out) < n:
        bits = rng.choice(out)
        for k in rng.sample(range(64), rng.choice([1, 2, 4, 5, 6])):
            bits ^= 1 << k
        out.append(bits)
    out += [(7 << 61) | rng.getrandbits(22) for _ in range(n // 4)]
    return sorted(set(out))


def components_of(spark, bits, monkeypatch=None, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(s, name, value)
    nodes = spark.createDataFrame([(int(np.uint64(b).view(np.int64)),) for b in bits], "bits long")
    trees = s.grow(nodes, len(bits))
    edges = s.links(s.cells(cut_lineage(s.members(nodes, trees, 1))), 1, 4).collect()
    place = {int(np.uint64(b).view(np.int64)): i for i, b in enumerate(bits)}
    assert all(int(np.bitwise_count(np.int64(e.a ^ e.b))) >= 0 for e in edges)
    return s.forest(len(bits), np.array([place[e.a] for e in edges], int), np.array([place[e.b] for e in edges], int)), trees


def test_equals_all_pairs(spark):
    rows = random_rows(150, vocabulary=200, length=60) + [(1000 + i, *r[1:]) for i, r in enumerate(odd_rows())]
    found = s.near_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


@pytest.mark.parametrize("sizes", [{}, {"SHARD": 32, "SAMPLE": 512, "LEAST_SAMPLE": 8}, {"SHARD": 64, "CELL": 24, "LEAF": 4, "SAMPLE": 128, "LEAST_SAMPLE": 4}])
def test_trees_lose_no_pair(spark, monkeypatch, sizes):
    bits = near_fingerprints(900)
    found, trees = components_of(spark, bits, monkeypatch, **sizes)
    assert (found == groups(bits)).all()
    assert (trees[0].depth > 0) == bool(sizes)


def test_a_pair_at_the_bound_meets_in_a_later_home():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 2**63, 500).astype(np.uint64)
    for block in s.BLOCKS:
        tree = s.Tree(sample, block, 5)
        a = rng.integers(0, 2**63, 4000).astype(np.uint64)
        lowest = block & (~block + np.uint64(1))
        b = a ^ lowest  # one bit apart in the block
        at = [{(r, leaf): home for r, leaf, home in zip(*(x.tolist() for x in tree.shards(side, 1)), strict=True)} for side in (a, b)]
        homes = [{r: leaf for (r, leaf), home in side.items() if home} for side in at]
        assert all((r, max(homes[0][r], homes[1][r])) in at[0] and (r, max(homes[0][r], homes[1][r])) in at[1] for r in range(len(a)))
        assert any(homes[0][r] != homes[1][r] for r in range(len(a)))
        # branches are pruned: most fingerprints visit few of the 32 shards
        assert len(at[0]) < 8 * len(a)


def test_a_hot_ball_leaves_few_edges(spark, monkeypatch):
    rng = random.Random(2)
    bits = sorted({12345 ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)} | {rng.getrandbits(64) for _ in range(200)})
    monkeypatch.setattr(s, "CELL", 300)
    nodes = spark.createDataFrame([(int(np.uint64(b).view(np.int64)),) for b in bits], "bits long")
    placed = cut_lineage(s.members(nodes, s.grow(nodes, len(bits)), 1))
    cells = s.cells(placed)
    sizes = [r["count"] for r in cells.groupBy("tree", "shard", "one", "two").count().collect()]
    assert max(sizes) <= 900
    assert s.links(cells, 1, 4).count() <= cells.count()


def test_odd_rows_and_no_rows(odd, nothing):
    assert sorted(map(tuple, s.near_components(odd).collect()), key=str) == brute(odd_rows())
    assert s.near_components(nothing).collect() == []


def test_shingles_in_small_portions(monkeypatch):
    import pyarrow as pa

    from riskweave.llm import words as w

    texts = [r[1] for r in random_rows(40)] + [r[1] for r in odd_rows()]
    monkeypatch.setattr(s, "HASHED", 7)
    found = [b for _, _, raw, starts in w.pieces(pa.array(texts), 300) for b in s.piece_fingerprints(raw, starts).tolist()]
    assert found == [fingerprint(t) for t in texts]


def test_a_piece_of_short_words_stays_small():
    raw = np.frombuffer(b"a b c d " * 62_500, np.uint8)
    tracemalloc.start()
    s.piece_fingerprints(raw, np.array([0, len(raw)]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80_000_000


def test_texts_are_handed_to_tasks_in_small_batches(spark, monkeypatch):
    sizes, before = [], spark.conf.get(BATCH_BYTES)

    def written(df):
        sizes.append(spark.conf.get(BATCH_BYTES))
        return cut_lineage(df)

    monkeypatch.setattr(s, "cut_lineage", written)
    assert s.near_components(frame(spark, random_rows(5))).count() == 5
    assert sizes[0] == str(s.HANDED) and set(sizes[1:]) == {before} == {spark.conf.get(BATCH_BYTES)}

    def rows(batches):
        yield from (pa.record_batch([pa.array([b.num_rows])], names=["n"]) for b in batches)

    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('a ', 4000) text")
    with arrow_bytes(spark, s.HANDED):
        found = [r["n"] for r in texts.mapInArrow(rows, "n long").collect()]
    assert sum(found) == 3000 and max(found) <= 500
