import itertools

import numpy as np
import pytest
from llm_fixtures import LOWER, frame, odd_rows, random_rows, words

from riskweave.llm import jaccard_join
from riskweave.llm.tables import components


def brute(rows, k, num, den):
    """(doc_id, n, component) of each row by comparing all pairs."""
    sets = []
    for _, text, *_ in rows:
        w = words((text or "").translate(LOWER))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and den * both >= num * len(sets[i] | sets[j]):
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    out = []
    for i, row in enumerate(rows):
        ids = [r[0] for r, g in zip(rows, group, strict=True) if g == group[i] and r[0] is not None]
        out.append((row[0], len(sets[i]), row[0] if not sets[i] else min(ids) if ids else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("k", "num"), [(3, 90), (2, 50), (5, 80)])
def test_equals_all_pairs(spark, k, num):
    rows = random_rows(150) + [(1000 + i, *r[1:]) for i, r in enumerate(odd_rows())]
    found = jaccard_join.jaccard_components(frame(spark, rows), k, num, 100).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, k, num, 100)


def test_blocks_and_slabs_change_nothing(spark, monkeypatch):
    rows = random_rows(120, vocabulary=12, length=12)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "SLAB", 7)
    found = jaccard_join.jaccard_components(frame(spark, rows), 2, 60, 100, orders=3).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, 2, 60, 100)


def test_odd_rows_and_no_rows(odd, nothing):
    found = jaccard_join.jaccard_components(odd).collect()
    assert sorted(map(tuple, found), key=str) == brute(odd_rows(), 5, 80, 100)
    assert jaccard_join.jaccard_components(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(0, 60)] + [(200, 300), (300, 400)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 200: 200, 300: 200, 400: 200}


@pytest.mark.parametrize(("share", "tokens", "rows_of_a_group"), [(0.2, 40, 16_384), (1.0, 1_000_000, 8), (20.0, 100, 8)])
def test_counted_share_buckets_and_groups_change_nothing(spark, monkeypatch, share, tokens, rows_of_a_group):
    rows = random_rows(120, vocabulary=12, length=25)
    monkeypatch.setattr(jaccard_join, "COUNTED", share)
    monkeypatch.setattr(jaccard_join, "BUCKET_TOKENS", tokens)
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", rows_of_a_group)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    found = jaccard_join.jaccard_components(frame(spark, rows), 3, 60, 100).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, 3, 60, 100)


def test_frequencies_are_those_of_all_documents(spark):
    rows = random_rows(200, vocabulary=15, length=30)
    docs = frame(spark, rows).repartition(5).selectExpr("doc_id as row", "doc_id", "text")
    pieced = jaccard_join.cut_lineage(jaccard_join.pieces(docs, 2, 80, 100))
    sets = [set(zip(w, w[1:], strict=False)) if len(w) > 1 else {tuple(w)} for w in (words(t) for _, t, *_ in rows)]
    # equal sets of a piece count once
    counted, shared = {}, {}
    for r in pieced.collect():
        for t in set(np.frombuffer(r["tokens"], np.uint64).tolist()):
            counted[t] = counted.get(t, 0)
        values = np.frombuffer(r["tokens"], np.uint64)
        for t, n in zip(*np.unique(values[jaccard_join._counted(values, 80, 100)], return_counts=True), strict=True):
            counted[int(t)] += int(n)
    for r in jaccard_join.shared_tokens(pieced, 80, 100).collect():
        shared |= dict(zip(np.frombuffer(r["tokens"], np.uint64).tolist(), np.frombuffer(r["frequencies"], np.uint32).tolist(), strict=True))
    assert shared == {t: n for t, n in counted.items() if n > 1}
    assert 0 < len(shared) <= len(set().union(*sets))
