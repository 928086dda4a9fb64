"""Training steps of the two classifiers against numeric gradients, and predictions against plain networks."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import language_crf, toxicity
from riskweave.llm import words as w


def numeric(loss, x, places, step=1e-5):
    out = []
    for place in places:
        kept = x[place]
        x[place] = kept + step
        high = loss()
        x[place] = kept - step
        low = loss()
        x[place] = kept
        out.append((high - low) / (2 * step))
    return np.array(out)


def test_transitions_and_emissions_of_the_field(monkeypatch):
    monkeypatch.setattr(language_crf, "BATCH", 2)
    monkeypatch.setattr(language_crf, "LENGTH", 4)
    rng, n = np.random.default_rng(4), 3
    model = language_crf.Crf(list("abc"), np.zeros((1, n)), np.zeros(0, np.uint64), rng.normal(size=n), rng.normal(size=(n, n)))
    e, gold = rng.normal(size=(8, n)), rng.integers(0, n, (2, 4))

    def path_score(i, path):
        own = e.reshape(2, 4, n)[i]
        return model.start[path[0]] + sum(own[t, y] for t, y in enumerate(path)) + sum(model.transitions[x, y] for x, y in itertools.pairwise(path))

    def loss():
        total = [np.log(sum(np.exp(path_score(i, p)) for p in np.ndindex(*[n] * 4))) - path_score(i, gold[i]) for i in range(2)]
        return np.mean(total)

    ends = np.array([0, 4, 8])
    p = language_crf.posteriors(e, ends, model.start, model.transitions)
    pairs = language_crf._pair_counts(e, p, model, gold)
    assert pairs.ravel() == pytest.approx(numeric(loss, model.transitions, list(np.ndindex(n, n))), abs=1e-7)
    error = (p - np.eye(n)[gold.ravel()]) / 2
    assert error.ravel() == pytest.approx(numeric(loss, e, list(np.ndindex(8, n))), abs=1e-7)
    assert error[ends[:-1]].sum(0) == pytest.approx(numeric(loss, model.start, [(k,) for k in range(n)]), abs=1e-7)


def test_emissions_are_sums_of_feature_weights():
    rng = np.random.default_rng(5)
    raw, starts = w.text_bytes(pa.array(["kato rena mi kato", "ünung", "x"]))
    found = w.Words(raw, starts, is_word=language_crf.LETTER)
    lexicon = np.unique(found.hashes())[:2]
    rows, begin, at = language_crf.features(found, lexicon)
    model = language_crf.Crf(["a", "b"], rng.normal(size=(language_crf.ROWS, 2)), lexicon, np.zeros(2), np.zeros((2, 2)))
    got = language_crf.emissions(model, rows, begin)
    assert got == pytest.approx(np.stack([model.weights[rows[a:b]].sum(0) for a, b in zip(begin, begin[1:], strict=False)]))
    # six affixes, the grams of three and four bytes, and one more in the lexicon
    hashes, sizes = found.hashes(), found.last + 1 - found.first
    for place, (h, size) in enumerate(zip(hashes, sizes, strict=True)):
        word = at[place]
        assert begin[word + 1] - begin[word] == 6 + max(0, size - 2) + max(0, size - 3) + (h in lexicon)


def small_network(rng, kind=np.float64):
    shapes = {width: (width, toxicity.WIDTH, n) for width, n in toxicity.FILTERS.items()}
    return toxicity.Model(
        rng.normal(0, 0.5, (toxicity.ROWS, toxicity.WIDTH)).astype(kind),
        {width: rng.normal(0, 0.5, s).astype(kind) for width, s in shapes.items()},
        {width: rng.normal(0, 0.1, n).astype(kind) for width, n in toxicity.FILTERS.items()},
        rng.normal(0, 0.5, sum(toxicity.FILTERS.values())).astype(kind),
        0.1, ["aa"], np.zeros((toxicity.ROWS, 1)), np.zeros(1),
    )


def plain_logit(model, rows, at):
    """Word by word and window by window."""
    vectors = [model.table[rows[word]].sum(0) for word in at]
    found = []
    for width, filters in model.filters.items():
        for f in range(filters.shape[2]):
            windows = [sum(vectors[i + j] @ filters[j, :, f] for j in range(width)) + model.bias[width][f] for i in range(len(at) - width + 1)]
            found.append(max([0.0, *windows]))
    return np.array(found) @ model.out + model.out_bias


TEXTS = ["one two three four two", "a", "", "bad bad words here and there, bad", "nothing of the kind"]


def parts_of(texts):
    raw, starts = w.text_bytes(pa.array(texts))
    return [toxicity.word_rows(raw[a:b], np.array([0, b - a])) for a, b in itertools.pairwise(starts.tolist())]


def test_predictions_equal_a_plain_network():
    model = small_network(np.random.default_rng(6), np.float32)
    got = toxicity.logits(model, *w.text_bytes(pa.array(TEXTS)))[0]
    assert got == pytest.approx([plain_logit(model, rows, at) for rows, at, _ in parts_of(TEXTS)], abs=1e-4)


def test_a_training_step_follows_the_gradient(monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    rng = np.random.default_rng(7)
    model, y = small_network(rng), np.array([1, 0, 0, 1, 0])
    texts = [(rows, at) for rows, at, _ in parts_of(TEXTS)]

    def loss():
        z = np.array([plain_logit(model, rows, at) for rows, at in texts])
        return np.mean(np.log1p(np.exp(z)) - y * z)

    # a row under some filter's largest response: training sets the others to zero
    rows = sorted({int(r) for words, _ in texts for r in words.ravel()})
    row = next(r for r in rows if np.abs(numeric(loss, model.table, [(r, 0), (r, 7)])).min() > 1e-3)
    watched = {
        "out": (model.out, [(0,), (5,), (11,)], 0.1),
        "filter": (model.filters[2], [(0, 1, 0), (1, 4, 2), (1, 0, 3)], 0.05),
        "bias": (model.bias[1], [(0,), (3,)], 0.05),
        "table": (model.table, [(row, 0), (row, 7)], 0.1),
    }
    wanted = {k: numeric(loss, x, places) for k, (x, places, _) in watched.items()}
    before = {k: np.array([x[p] for p in places]) for k, (x, places, _) in watched.items()}
    toxicity._fit_network(model, texts, y, rng)
    for k, (x, places, rate) in watched.items():
        moved = before[k] - np.array([x[p] for p in places])
        # a first Adagrad step is rate * g / sqrt(0.001 + g * g)
        gradient = moved * np.sqrt(1e-3) / np.sqrt(np.maximum(rate * rate - moved * moved, 1e-12))
        assert gradient == pytest.approx(wanted[k], abs=2e-4), k
    assert loss() < np.inf
