import zlib

import numpy as np
import pytest
from llm_fixtures import frame, key, odd_rows, random_rows

from riskweave.llm import sharding
from riskweave.llm.sharding import hilbert_index


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (3, 3), (3, 5), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(n, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    place = hilbert_index(list(grid.T), bits)
    assert sorted(place) == list(range(len(grid)))
    assert np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(1).max() == 1


def check(rows, found, shards):
    size = lambda r: len((r[1] or "").encode()) + 16
    expected = [(r[0], size(r), zlib.crc32((r[1] or "").encode())) for r in rows]
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"]) for r in found], key=key) == sorted(expected, key=key)
    total, largest = sum(map(size, rows)), max(map(size, rows))
    for s in range(shards):
        part = sorted((r for r in found if r["shard"] == s), key=lambda r: r["slot"])
        assert [r["slot"] for r in part] == list(range(len(part)))
        assert [r["curve"] for r in part] == sorted(r["curve"] for r in part)
        # a shard misses its share by the row on each border, or a group that is never cut
        slack = 2 * max(largest, total / shards / sharding.WHOLE)
        assert abs(sum(r["size"] for r in part) - total / shards) <= slack
    order = [(r["shard"], r["curve"]) for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_equal_runs_of_the_curve(spark):
    rows = random_rows(600, length=60)
    check(rows, sharding.assign(frame(spark, rows), shards=8).collect(), 8)


def test_large_group_is_cut_and_small_ones_are_not(spark):
    rows = random_rows(300) + [(1000 + i, "the same text again and again", "fr", f"s{i}", 0) for i in range(400)]
    rows += [(3000 + i, f"pair {i // 2}", ("en", "de")[i % 2], f"s{i}", 0) for i in range(20)]
    found = sharding.assign(frame(spark, rows), shards=5).collect()
    check(rows, found, 5)
    place = {r["doc_id"]: r["shard"] for r in found}
    assert len({place[1000 + i] for i in range(400)}) > 1
    assert all(place[3000 + i] == place[3001 + i] for i in range(0, 20, 2))


def test_odd_rows_and_no_rows(odd, nothing):
    check(odd_rows(), sharding.assign(odd, shards=3).collect(), 3)
    assert sharding.assign(nothing).count() == 0


def test_written_shards_hold_the_rows(spark, tmp_path):
    rows = random_rows(60) + odd_rows() + [odd_rows()[0]] * 4
    docs = frame(spark, rows)
    sharding.write_shards(docs, str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(tuple, back.select(*docs.columns).collect()), key=key) == sorted(rows, key=key)
    for _, part in back.select("shard", "slot").toPandas().groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
