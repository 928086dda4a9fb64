import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import LOWER, frame, odd_rows, random_rows, words

from riskweave.llm import backoff_lm


def brute(rows, order, alpha=0.4):
    texts = [words((r[1] or "").translate(LOWER)) for r in rows]

    def grams(ws):
        return Counter(tuple(ws[i : i + n]) for n in range(1, order + 1) for i in range(len(ws) - n + 1))

    every = sum((grams(ws) for ws in texts), Counter())
    total = sum(map(len, texts))
    out = []
    for row, ws in zip(rows, texts, strict=True):
        own, score = grams(ws), 0.0
        left = lambda g: every[g] - own[g]  # noqa: B023, E731
        for i in range(len(ws)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                g = tuple(ws[i - n + 1 : i + 1])
                if n == 1:
                    share = max(left(g), 1) / max(total - len(ws), 1)
                elif left(g) > 0:
                    share = left(g) / left(g[:-1])
                else:
                    continue
                score += math.log(share) + (longest - n) * math.log(alpha)
                break
        out.append((row[0], len(ws), round(score, 6) if ws else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_equals_plain_counting(spark, monkeypatch, order):
    monkeypatch.setattr(backoff_lm, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(backoff_lm, "PARTITION_BYTES", 3000)
    rows = random_rows(120)
    found = backoff_lm.scores(frame(spark, rows), order).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["log_score"] and round(r["log_score"], 6)) for r in found), key=str) == brute(rows, order)


def test_odd_rows_and_no_rows(odd, nothing):
    found = backoff_lm.scores(odd).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["log_score"] and round(r["log_score"], 6)) for r in found), key=str) == brute(odd_rows(), 3)
    assert backoff_lm.scores(nothing).count() == 0


def test_hashes_that_differ_in_their_last_bit_are_different_keys(monkeypatch):
    monkeypatch.setattr(backoff_lm.w, "grams", lambda one, at, n: (np.arange(len(one) - n + 1, dtype=np.uint64), None))
    grams = backoff_lm.keys(pa.chunked_array([["a b c d"]]), 2)[0]
    assert [g.tolist() for g in grams] == [[0, 1, 2, 3], [0, 1, 2]]


@pytest.mark.parametrize("top", [1, 2, 300, 1 << 44, (1 << 64) - 1])
@pytest.mark.parametrize("n", [0, 1, 5000])
def test_squeezed_integers_come_back(top, n):
    values = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64, endpoint=True)
    assert backoff_lm.expand(backoff_lm.squeeze(values)).tolist() == values.tolist()
