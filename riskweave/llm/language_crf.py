"""Language of every word, and of every text, by a linear-chain conditional random field.

A word is a run of letters (any byte above 127 counts as one), lower-cased. Its features are affixes (first and last two to
four bytes), the byte 3- and 4-grams inside, and the word itself if the training sample's lexicon has it. A word's score
for a label is the sum of its features' weights; learned transitions join neighbouring words. Forward-backward gives each
word its label probabilities given the whole text; a text's language is the label with the largest sum of them, and the
score is that label's mean.

Training takes at most ``PER_LABEL`` documents of each language and ``MOST`` in all, the first in a fixed pseudo-random
order. Their words are cut into spans and spliced, so that half of the training sequences switch language, and the
likelihood is climbed by Adagrad with the exact gradient of forward-backward.

Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing can be learned. Ties go to the
label that sorts first. Long texts are read whole; memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as w
from riskweave.llm.tables import held_out, sample_texts

PER_LABEL = 300
MOST = 3000
ROWS = 1 << 18  # of the weight table; its size is fixed
LENGTH = 64  # words of a training sequence
BATCH = 64
STEPS = 250
RATE = 0.2

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # (ROWS, labels)
    lexicon: np.ndarray  # sorted hashes of the sample's words
    start: np.ndarray
    transitions: np.ndarray


def features(found: w.Words, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight rows of each distinct word's features, where each word's begin, and the distinct word at each place."""
    full, first, at = np.unique(found.hashes(), return_index=True, return_inverse=True)
    low, end = found.first[first], found.last[first] + 1
    size = end - low
    owner, rows = [], []

    def add(who: np.ndarray, hashes: np.ndarray, kind: int) -> None:
        owner.append(who)
        rows.append((w.scramble(hashes, kind) % np.uint64(ROWS)).astype(np.int64))

    everyone = np.arange(len(full))
    for n in (2, 3, 4):
        add(everyone, found.span_hash(low, np.minimum(low + n, end)), n)
        add(everyone, found.span_hash(np.maximum(end - n, low), end), 10 + n)
    for n in (3, 4):
        count = np.maximum(size - n + 1, 0)
        who = np.repeat(everyone, count)
        begin = low[who] + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
        add(who, found.span_hash(begin, begin + n), 20 + n)
    if len(lexicon):
        spot = np.searchsorted(lexicon, full).clip(max=len(lexicon) - 1)
        known = everyone[lexicon[spot] == full]
        add(known, full[known], 30)
    who, rows = np.concatenate(owner), np.concatenate(rows)
    order = np.argsort(who, kind="stable")
    return rows[order], np.searchsorted(who[order], np.arange(len(full) + 1)), at


def emissions(model: Crf, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(distinct words, labels): every word has affixes, so no stretch of ``rows`` is empty."""
    return np.add.reduceat(model.weights[rows], begin[:-1], axis=0)


def posteriors(e: np.ndarray, begin: np.ndarray, start: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities of each word given its whole text, by scaled forward-backward over all texts at once.

    Texts are ordered by length, so the texts that have a word at place t are a prefix of them.
    """
    count = np.diff(begin)
    order = np.argsort(-count, kind="stable")
    first, count = begin[:-1][order], count[order]
    e = np.exp(e - e.max(1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(e), np.ones_like(e)
    active = np.searchsorted(-count, -np.arange(count[0] if len(count) else 0), "left")
    state = None
    for t, n in enumerate(active):
        here = first[:n] + t
        state = e[here] * (np.exp(start - start.max()) if t == 0 else state[:n] @ step)
        state /= state.sum(1, keepdims=True)
        forward[here] = state
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        after = first[:n] + t + 1
        state = (e[after] * backward[after]) @ step.T
        backward[after - 1] = state / state.sum(1, keepdims=True)
    both = forward * backward
    return both / both.sum(1, keepdims=True)


def _sequences(parts: list[tuple[np.ndarray, int]], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A batch of spliced sequences: distinct-word numbers and labels, (BATCH, LENGTH)."""
    words, labels = np.empty((BATCH, LENGTH), np.int64), np.empty((BATCH, LENGTH), np.int64)
    for i in range(BATCH):
        done = 0
        switching = i % 2
        while done < LENGTH:
            text, label = parts[rng.integers(len(parts))]
            size = min(LENGTH - done, len(text), int(rng.integers(4, 30)) if switching else LENGTH)
            low = int(rng.integers(len(text) - size + 1))
            words[i, done : done + size] = text[low : low + size]
            labels[i, done : done + size] = label
            done += size
    return words, labels


def fit(rows: list[tuple], seed: int = 1) -> Crf | None:
    """A field from (text, lang) rows; None if there is nothing to learn."""
    labels = sorted({lang for text, lang in rows if lang is not None and text})
    raw, starts = w.text_bytes(pc.utf8_lower(pa.array([t for t, _ in rows], pa.string())))
    found = w.Words(raw, starts, is_word=LETTER)
    if not labels or not len(found):
        return None
    lexicon, seen = np.unique(found.hashes(), return_counts=True)
    lexicon = lexicon[seen > 1]
    n = len(labels)
    model = Crf(labels, np.zeros((ROWS, n)), lexicon, np.zeros(n), np.zeros((n, n)))
    feature, begin, at = features(found, lexicon)
    parts = [
        (at[found.at[i] : found.at[i + 1]], labels.index(lang))
        for i, (_, lang) in enumerate(rows)
        if lang is not None and found.at[i + 1] > found.at[i]
    ]
    if not parts:
        return None
    rng = np.random.default_rng(seed)
    squares = [np.full(x.shape, 1e-2) for x in (model.weights, model.start, model.transitions)]
    ends = np.arange(0, BATCH * LENGTH + 1, LENGTH)
    eye = np.eye(n)
    for _ in range(STEPS):
        words, gold = _sequences(parts, rng)
        distinct, where = np.unique(words, return_inverse=True)
        where = where.ravel()
        size = begin[distinct + 1] - begin[distinct]
        own = np.repeat(begin[distinct], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        used = feature[own]
        e = np.add.reduceat(model.weights[used], np.cumsum(size) - size, axis=0)[where]
        p = posteriors(e, ends, model.start, model.transitions)
        error = p - eye[gold.ravel()]
        pairs = _pair_counts(e, p, model, gold)
        # a row's gradient is the error of all words that have the feature
        per_word = np.zeros((len(distinct), n))
        np.add.at(per_word, where, error)
        ids, spot = np.unique(used, return_inverse=True)
        grad = np.stack([np.bincount(spot, np.repeat(per_word[:, k], size), len(ids)) for k in range(n)], 1) / BATCH
        grad += 1e-4 * model.weights[ids]
        squares[0][ids] += grad * grad
        model.weights[ids] -= RATE * grad / np.sqrt(squares[0][ids])
        first = error[ends[:-1]].mean(0)
        for x, g, s in ((model.start, first, squares[1]), (model.transitions, pairs, squares[2])):
            s += g * g
            x -= RATE * g / np.sqrt(s)
    return model


def _pair_counts(e: np.ndarray, p: np.ndarray, model: Crf, gold: np.ndarray) -> np.ndarray:
    """Gradient of the transitions: expected minus seen neighbours, per sequence.

    Given a word's posterior, the next label's distribution is the transition times what follows, so the pair is
    p(next) * p(this | next, past); it is taken from the exact forward messages.
    """
    n = len(model.labels)
    shaped = np.exp(e - e.max(1, keepdims=True)).reshape(BATCH, LENGTH, n)
    step = np.exp(model.transitions)
    state = shaped[:, 0] * np.exp(model.start)
    state /= state.sum(1, keepdims=True)
    after = p.reshape(BATCH, LENGTH, n)
    total = np.zeros((n, n))
    for t in range(1, LENGTH):
        joint = state[:, :, None] * step
        joint /= joint.sum(1, keepdims=True)
        total += (joint * after[:, t, None, :]).sum(0)
        state = shaped[:, t] * (state @ step)
        state /= state.sum(1, keepdims=True)
    seen = np.zeros((n, n))
    np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    return (total - seen) / BATCH


def word_posteriors(model: Crf, raw: np.ndarray, starts: np.ndarray) -> tuple[w.Words, np.ndarray]:
    found = w.Words(raw, starts, is_word=LETTER)
    if not len(found):
        return found, np.zeros((0, len(model.labels)))
    rows, begin, at = features(found, model.lexicon)
    return found, posteriors(emissions(model, rows, begin)[at], found.at, model.start, model.transitions)


def training_rows(docs: DataFrame, per_label: int = PER_LABEL, most: int = MOST) -> list[tuple]:
    keys = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    keys = keys.select("doc_id", "lang", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("size")).distinct()
    return sample_texts(docs, keys, ["lang"], per_label, most)


def predict(docs: DataFrame, model: Crf | None) -> DataFrame:
    """(doc_id, lang_pred, score, switches): ``switches`` counts neighbouring words whose likeliest labels differ."""
    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    if model is None:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("switches"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.labels, "und"], object)
        for batch in batches:
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            for low, high, raw, starts in w.pieces(pc.utf8_lower(batch.column(1))):
                found, p = word_posteriors(m, raw, starts)
                total = np.zeros((len(p) + 1, len(m.labels)))
                np.cumsum(p, axis=0, out=total[1:])
                count = np.diff(found.at)
                mean = (total[found.at[1:]] - total[found.at[:-1]]) / np.maximum(count, 1)[:, None]
                best = p.argmax(1)
                changes = np.zeros(len(p) + 1, np.int64)
                changes[2:] = np.cumsum(best[1:] != best[:-1])[: max(0, len(p) - 1)]
                switches = changes[found.at[1:]] - changes[np.minimum(found.at[:-1] + 1, found.at[1:])]
                pick = mean.argmax(1)
                score = np.clip(mean.max(1), 0, 1)
                known = letters[low:high] & (count > 0)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(names[np.where(known, pick, len(m.labels))], pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                        pa.array(np.where(known, switches, 0)),
                    ],
                    names=["doc_id", "lang_pred", "score", "switches"],
                )

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, switches long")


def word_spans(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, first_word, words, lang): the runs of words with one likeliest label, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array(m.labels, object)
        for batch in batches:
            for low, high, raw, starts in w.pieces(pc.utf8_lower(batch.column(1))):
                found, p = word_posteriors(m, raw, starts)
                best, text = p.argmax(1), found.text_of
                new = np.ones(len(best), bool)
                new[1:] = (best[1:] != best[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                size = np.diff(np.append(first, len(best)))
                ids = batch.column(0).slice(low, high - low).take(pa.array(text[first]))
                yield pa.record_batch(
                    [ids, pa.array(first - found.at[text[first]]), pa.array(size), pa.array(names[best[first]], pa.string())],
                    names=["doc_id", "first_word", "words", "lang"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, first_word long, words long, lang string")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, switches) of every document, by a field fitted outside the held-out fifth."""
    found = predict(docs, fit(training_rows(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "switches")
