import random
import re

import numpy as np
import pyarrow as pa
from llm_fixtures import odd_rows, words

from riskweave.llm import repetition
from riskweave.llm import words as w


def brute(text, least):
    ws = words(text)
    n = len(ws)

    def cover(k):
        seen = {}
        for i in range(n - k + 1):
            seen.setdefault(tuple(ws[i : i + k]), []).append(i)
        return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + k)})

    longest = 0
    while longest < n and len({tuple(ws[i : i + longest + 1]) for i in range(n - longest)}) < n - longest:
        longest += 1
    lines, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in lines
            lines.add(line)
    return [n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), again, cover(5), cover(least), longest]


def random_texts(count):
    rng = random.Random(1)
    signs = "é#$a"
    for _ in range(count):
        n, v = rng.choice([0, 1, 2, 5, 12, 40, 120]), rng.choice([1, 2, 3, 8, 50])
        parts = [rng.choice([" ", "\n", "  ", "\t"]) + signs[: rng.randint(1, 4)] * (1 + rng.randrange(v)) for _ in range(n)]
        yield "".join(parts) + rng.choice(["", "\n", " "])


def test_measures_equal_plain_counting():
    texts = [*random_texts(300), None, "", "\n\n", "a\n\na\n a\na", "a b c d e f a b c d e f"]
    for size in (10**9, 50):
        got = []
        for _, _, raw, starts in w.pieces(pa.array(texts), size):
            m = repetition.measure(raw, starts, 6)
            got += np.stack([m[c] for c in repetition.COUNTS], 1).tolist()
        assert got == [brute(t, 6) for t in texts]


def test_verdicts(odd, nothing):
    found = {tuple(r) for r in repetition.judge(odd).collect()}
    expected = set()
    for doc_id, text, *_ in odd_rows():
        if text and len(text) > 10_000:
            continue  # the plain version takes too long; below
        n, chars, signs, lines, five, six, longest = brute(text, 6)
        failed = n < 10 or 100 * five > 20 * n
        expected.add((doc_id, n, chars, signs, lines, five, six, longest, failed, not failed and six <= 0.15 * n and longest <= 50))
    assert expected <= found
    long = {r["doc_id"]: r for r in repetition.judge(odd).collect() if r["doc_id"] in (9, 10)}
    assert (long[9]["n_words"], long[9]["n_repeat_words"], long[9]["longest_repeat"]) == (30_000, 30_000, 29_003)
    assert (long[10]["n_words"], long[10]["word_chars"], long[10]["kept"]) == (1, 50_000, False)
    assert repetition.judge(odd).count() == len(odd_rows())
    assert repetition.judge(nothing).count() == 0


def test_spans_cover_what_is_counted(odd):
    spans = {}
    for r in repetition.repeat_spans(odd).collect():
        spans[r["doc_id"]] = spans.get(r["doc_id"], 0) + r["words"]
    counts = {r["doc_id"]: r["covered_words"] for r in repetition.judge(odd).collect() if r["covered_words"]}
    assert spans == counts
