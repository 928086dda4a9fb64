"""Repetition inside a text, found with a suffix array over its words.

Words are ``[^\\x20\\x09-\\x0D]+``, compared as they stand. All suffixes of all texts of a piece are sorted by prefix
doubling: ranks by the first 1, 2, 4, ... words, where each round only sorts again what is still tied. The ranks of the rounds
also give the longest common prefix of neighbours in the array. Every suffix lies in nested longest-common-prefix
intervals; the deepest one holds its longest repeated beginning, and the shorter ones cover no other words. A repeat of
``MIN_WORDS`` or more is therefore covered by the union of these beginnings, and the longest is the longest repeat.

A text is kept if it has ten words or more, if at most a fifth of its words lie in 5-word windows that occur twice, and if
repeats of ``MIN_WORDS`` words cover at most ``MAX_COVERED`` of it and none is longer than ``MAX_LONGEST`` words.

Null and empty texts have no words and fail. Repeated rows are judged each. Texts are read whole; a piece of work holds
about half a megabyte of texts, or one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm import words as w

MIN_WORDS = 6
MAX_COVERED = 0.15
MAX_LONGEST = 50
WINDOW = 5
LEAST_WORDS = 10
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def suffix_ranks(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of all texts (sorted by text first), and the ranks by the first 1, 2, 4, ... words.

    Equal ranks of a round mean equal words as far as the round looks, in the same text. Ranks past the end of a text
    count as lowest, so no two suffixes stay equal.
    """
    n = len(symbols)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    end = at[1:][text]
    order = np.lexsort((symbols, text))
    new = np.ones(n, bool)
    new[1:] = (symbols[order][1:] != symbols[order][:-1]) | (text[order][1:] != text[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rounds = [rank]
    k = 1
    while True:
        # places in the array whose rank is shared with a neighbour
        tied = ~new
        tied[:-1] |= ~new[1:]
        spots = np.flatnonzero(tied)
        if not len(spots):
            return order, rounds
        who = order[spots]
        ahead = who + k
        second = np.where(ahead < end[who], rank[np.minimum(ahead, n - 1)], -1)
        again = np.lexsort((second, rank[who]))
        who, second = who[again], second[again]
        order[spots] = who
        first = rank[who]
        fresh = np.ones(len(who), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        new[spots] = fresh
        rank = rank.copy()
        rank[who] = spots[np.maximum.accumulate(np.where(fresh, np.arange(len(who)), 0))]
        rounds.append(rank)
        k *= 2


def longest_repeats(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """At each word, the length of the longest run that begins there and occurs again in the same text."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    order, rounds = suffix_ranks(symbols, at)
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    live = np.flatnonzero(rounds[0][left] == rounds[0][right])
    for level in range(len(rounds) - 1, -1, -1):
        a, b = left[live], right[live]
        inside = (a < n) & (b < n)
        same = np.zeros(len(live), bool)
        same[inside] = rounds[level][a[inside]] == rounds[level][b[inside]]
        hit = live[same]
        common[hit] += 1 << level
        left[hit] += 1 << level
        right[hit] += 1 << level
    out = np.zeros(n, np.int64)
    out[order[1:]] = common
    out[order[:-1]] = np.maximum(out[order[:-1]], common)
    return out


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a run of ``least`` words or more that occurs twice."""
    steps = np.zeros(len(longest) + 1, np.int64)
    first = np.flatnonzero(longest >= least)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + longest[first], -1)
    return np.cumsum(steps[:-1]) > 0


def _repeated_lines(found: w.Words, raw: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    n_texts = len(found.at) - 1
    breaks = np.flatnonzero(raw == 10)
    low = np.sort(np.concatenate([found.starts[:-1], breaks + 1]), kind="stable")
    text = np.searchsorted(found.starts, low, "right") - 1
    text = np.minimum(text, n_texts - 1)
    high = np.empty_like(low)
    high[:-1] = low[1:]
    high[-1:] = len(raw)
    # a line ends before its break, or where the text ends
    high -= ((high > low) & (raw[np.maximum(high - 1, 0)] == 10) if len(raw) else np.zeros(len(low), bool)).astype(np.int64)
    filled = np.searchsorted(found.first, high) > np.searchsorted(found.first, low)
    low, high, text = low[filled], high[filled], text[filled]
    keys = found.span_hash(low, high)
    order = np.lexsort((keys, text))
    again = np.zeros(len(order), bool)
    again[1:] = (keys[order][1:] == keys[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text[order][again], minlength=n_texts)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def measure(raw: np.ndarray, starts: np.ndarray, min_words: int) -> dict[str, np.ndarray]:
    found = w.Words(raw, starts, lower=False)
    counts = np.diff(found.at)
    longest = longest_repeats(found.hashes(), found.at)
    deepest = np.zeros(len(counts), np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        deepest[full] = np.maximum.reduceat(longest, found.at[:-1][full])
    return {
        "n_words": counts,
        "word_chars": _sums(~w.SPACE[raw] & ((raw & 0xC0) != 0x80), starts),
        "n_symbols": _sums(SYMBOL[raw], starts),
        "n_dup_lines": _repeated_lines(found, raw),
        "n_repeat_words": _sums(covered(longest, WINDOW), found.at),
        "covered_words": _sums(covered(longest, min_words), found.at),
        "longest_repeat": deepest,
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def judge(
    docs: DataFrame, min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST
) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, starts in w.pieces(batch.column(1)):
                m = measure(raw, starts, min_words)
                failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
                fine = (m["covered_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_longest)
                columns = [pa.array(m[c].astype(np.int64)) for c in COUNTS]
                yield pa.record_batch(
                    [batch.column(0).slice(low, high - low), *columns, pa.array(failed), pa.array(~failed & fine)],
                    names=["doc_id", *COUNTS, "base_failed", "kept"],
                )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def repeat_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, first_word, words): the united spans of words that repeats of ``min_words`` or more cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, starts in w.pieces(batch.column(1)):
                found = w.Words(raw, starts, lower=False)
                inside = covered(longest_repeats(found.hashes(), found.at), min_words)
                text = found.text_of
                border = np.ones(len(inside), bool)
                border[1:] = (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
                first = np.flatnonzero(border)
                size = np.diff(np.append(first, len(inside)))
                first, size = first[inside[first]], size[inside[first]]
                ids = batch.column(0).slice(low, high - low).take(pa.array(text[first]))
                columns = [ids, pa.array(first - found.at[text[first]]), pa.array(size)]
                yield pa.record_batch(columns, names=["doc_id", "first_word", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, first_word long, words long")
