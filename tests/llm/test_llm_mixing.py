import hashlib
from collections import defaultdict

import pytest
from llm_fixtures import frame, key, odd_rows, random_rows, words
from pyspark.sql import functions as F

from riskweave.llm import mixing


def water(sizes, weights, most=3):
    """Targets by sharing again and again until none is above its limit."""
    left, target, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        unit = left / sum(weights[i] for i in free)
        over = {i for i in free if unit * weights[i] > most * sizes[i]}
        if not over:
            for i in free:
                target[i] = unit * weights[i]
            break
        for i in over:
            target[i] = most * sizes[i]
            left -= target[i]
        free -= over
    return target


def brute(rows):
    """Sorted (id, source, size, source size, target, taken): what lies before the quota in each source's stream."""
    by_source = defaultdict(list)
    for doc_id, text, _, source, _ in rows:
        place = hashlib.md5(str("" if doc_id is None else doc_id).encode()).hexdigest()
        by_source[source].append((place, len(words(text)), doc_id))
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(n for _, n, _ in by_source[s]) for s in names]
    targets = water(sizes, [1 + i % 3 for i in range(len(names))])
    out = []
    for name, size, target in zip(names, sizes, targets, strict=True):
        quota, start = int(target + 0.5), 0
        for _, n, doc_id in sorted(by_source[name], key=lambda x: x[:2]):
            taken = sum(max(0, min(start + e * size + n, quota) - min(start + e * size, quota)) for e in range(3))
            out.append((doc_id, name, n, size, round(target, 6), taken))
            start += n
    return sorted(out, key=key)


def plain(mixed):
    return [(r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixed.collect()]


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_equals_plain_streams(spark, block):
    rows = [(i, t, lang, f"s{i % 7}" if i % 11 else None, n) for i, t, lang, _, n in random_rows(80)]
    rows += [(1000 + i, "word " * i, "en", "tiny" if i < 3 else "s1", 0) for i in range(12)]
    found = plain(mixing.mix(frame(spark, rows), block))
    assert sorted(found, key=key) == brute(rows)


def test_odd_rows_and_no_rows(odd, nothing):
    found = plain(mixing.mix(odd))
    assert sorted(found, key=key) == brute(odd_rows())
    assert mixing.mix(nothing).count() == 0


def test_no_words_at_all(spark):
    found = mixing.mix(frame(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 0)])).collect()
    assert sorted((r["doc_id"], r["target"], r["taken"]) for r in found) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_every_stretch_of_the_schedule_is_mixed(spark):
    sized = spark.createDataFrame([("a", 60_000), ("b", 30_000), ("c", 10_000)], "source string, size long")
    per_source = mixing.targets(sized)
    slots = mixing.schedule(per_source, block=100).orderBy("slot").toPandas()
    share = {r["source"]: r["quota"] for r in per_source.collect()}
    total = sum(share.values())
    assert slots.groupby("source")["last"].max().to_dict() == share
    assert not slots.duplicated(["source", "rank"]).any()
    for low in range(0, len(slots) - 200, 100):
        part = slots.iloc[low : low + 100].source.value_counts()
        assert all(abs(part.get(s, 0) - 100 * q / total) <= 8 for s, q in share.items())


def test_only_dataframe_operations(odd):
    plan = mixing.mix(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_reruns_agree(odd):
    order = ["doc_id", "source", "size", "taken"]
    first, second = (sorted(map(tuple, mixing.mix(odd).select(*order).collect()), key=key) for _ in range(2))
    assert first == second
    assert mixing.mix(odd).agg(F.sum("taken")).first()[0] > 0


def test_the_sequence_is_the_mix(spark):
    rows = [(i, t, lang, f"s{i % 3}", n) for i, t, lang, _, n in random_rows(60)]
    found = mixing.sequence(frame(spark, rows), block=16).orderBy("slot", "offset").toPandas()
    text = {i: words(t) for i, t, *_ in rows}
    # blocks hold their words without gap or overlap, and one source each
    for _, part in found.groupby("slot"):
        length = part.last_word - part.first_word
        assert part.source.nunique() == 1 and (length > 0).all()
        assert list(part.offset) == [0, *length.cumsum()[:-1]] and length.sum() <= 16
    assert all(r.last_word <= len(text[r.doc_id]) for r in found.itertuples())
    taken = (found.last_word - found.first_word).groupby(found.doc_id).sum().to_dict()
    mixed = {r.doc_id: r.taken for r in mixing.mix(frame(spark, rows), block=16).collect()}
    assert {i: n for i, n in mixed.items() if n} == taken


def test_other_points_change_the_sequence_and_not_the_sums(spark):
    rows = [(i, t, lang, f"s{i % 3}", n) for i, t, lang, _, n in random_rows(60)]
    df = frame(spark, rows)
    order = [[tuple(r) for r in mixing.sequence(df, 16, ratio).select("slot", "offset", "doc_id", "first_word").orderBy("slot", "offset").collect()] for ratio in (mixing.GOLDEN, 0.41421356237309515)]
    assert order[0] != order[1]
    assert plain(mixing.mix(df, 16).orderBy("doc_id")) == plain(mixing.mix(df, 16, 0.41421356237309515).orderBy("doc_id"))
