"""Trained operators: language, toxicity; and the search for benchmark items."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import frame, is_held_out, odd_rows, random_rows

from riskweave.llm import decontaminate, language_crf, toxicity
from riskweave.llm import words as w

SYLLABLES = {"aa": ["ka", "to", "mi", "ren"], "bb": ["oul", "eux", "ché", "ais"], "cc": ["sch", "ung", "pf", "ein"]}


def language_rows(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 40))]
        rows.append((i, " ".join(text), lang, "s", 0))
    return rows


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(0)
    n, lengths = 3, [4, 1, 3]
    begin = np.concatenate([[0], np.cumsum(lengths)])
    e, start, step = rng.normal(size=(8, n)), rng.normal(size=n), rng.normal(size=(n, n))
    got = language_crf.posteriors(e, begin, start, step)
    for a, b in zip(begin, begin[1:], strict=False):
        total = np.zeros((b - a, n))
        for path in np.ndindex(*[n] * (b - a)):
            s = start[path[0]] + sum(e[a + t, y] for t, y in enumerate(path)) + sum(step[x, y] for x, y in zip(path, path[1:], strict=False))
            for t, y in enumerate(path):
                total[t, y] += np.exp(s)
        assert got[a:b] == pytest.approx(total / total.sum(1, keepdims=True))


def test_language_of_unseen_documents_and_of_switched_words(spark, odd, nothing):
    rows = language_rows(200)
    docs = frame(spark, rows)
    found = {r["doc_id"]: r for r in language_crf.identify(docs).collect()}
    assert all(found[r[0]]["held_out"] == is_held_out(r[0]) for r in rows)
    held = [r for r in rows if is_held_out(r[0])]
    assert sum(found[r[0]]["lang_pred"] == r[2] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())
    model = language_crf.fit(language_crf.training_rows(docs))
    mixed = frame(spark, [(1, "kato mito renka mika tomi pfung schein einpf schung pfein einung", None, None, None)])
    spans = language_crf.word_spans(mixed, model).orderBy("first_word").collect()
    assert [(r["first_word"], r["words"], r["lang"]) for r in spans] == [(0, 5, "aa"), (5, 6, "cc")]
    assert language_crf.predict(mixed, model).first()["switches"] == 1

    judged = language_crf.predict(odd, model).collect()
    assert len(judged) == len(odd_rows())
    assert {r["lang_pred"] for r in judged if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert {(r["lang_pred"], r["score"]) for r in language_crf.predict(odd, None).collect()} == {("und", 0.0)}
    assert language_crf.identify(nothing).count() == 0


def test_longer_neighbours_do_not_change_a_text(spark):
    model = language_crf.fit([(r[1], r[2]) for r in language_rows(60)])
    texts = [r[1] for r in language_rows(20, seed=9)] + ["kato " * 3000]
    alone = [language_crf.word_posteriors(model, *w.text_bytes(pa.array([t])))[1] for t in texts]
    together = language_crf.word_posteriors(model, *w.text_bytes(pa.array(texts)))[1]
    assert np.concatenate(alone) == pytest.approx(together)


def toxic_rows(n, seed=4):
    rng = random.Random(seed)
    bad = ["blarg", "blargon", "snib"]
    rows, labels = [], []
    for i in range(n):
        text = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.3
        for _ in range(3 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), ("en", "fr")[i % 2], "s", 0))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_of_unseen_documents(spark, odd, nothing):
    rows, marks = toxic_rows(400)
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.predict(docs, labels).collect()}
    held = [(i, t) for i, t in marks if is_held_out(i)]
    assert sum(found[i]["predicted"] == t for i, t in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found.values())

    model = toxicity.fit(toxicity.training_rows(docs, labels))
    scored = toxicity.score(odd, model).collect()
    assert len(scored) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 for r in scored)
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r["score"] < 0.5 for r in scored)
    assert toxicity.predict(nothing, labels).count() == 0
    assert {r["score"] for r in toxicity.predict(odd, labels.limit(0)).collect()} == {0.0}


def test_pooling_stays_inside_a_text():
    rows, marks = toxic_rows(120)
    model = toxicity.fit([(r[1], r[2], t) for r, (_, t) in zip(rows, marks, strict=True)])
    texts = [r[1] for r in rows[:30]] + ["", "blarg", "one two", None]
    together = toxicity.logits(model, *w.text_bytes(pa.array(texts)))[0]
    alone = [toxicity.logits(model, *w.text_bytes(pa.array([t], pa.string())))[0][0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-4)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_planted_items_are_found_and_clean_texts_left_alone(spark, monkeypatch):
    rng = random.Random(6)
    bench = [(i, " ".join(f"v{rng.randrange(400)}" for _ in range(rng.randint(12, 40))) + ". The end is " + f"v{i} q{i} z{i}") for i in range(30)]
    rows, planted = random_rows(80, vocabulary=400, length=300), set()
    for i, text in bench:
        doc, words = i * 2, rows[i * 2][1].split()
        words[len(words) // 2 : len(words) // 2] = (text.upper() if i % 3 else text).split()
        rows[doc] = (doc, " ".join(words), "en", "s", 0)
        planted.add((doc, i))
    rows.append((500, " ".join(bench[0][1].split()[:6]), "en", "s", 0))  # too little of it
    rows += [(600 + i, None if i else "", "en", "s", 0) for i in range(2)]
    docs = frame(spark, rows, clashing=True)
    for shards in (10**6, 200):
        monkeypatch.setattr(decontaminate, "POSTINGS", shards)
        found = decontaminate.contaminated(docs, items(spark, [*bench, (90, None), (91, ""), bench[3]]))
        assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == planted


def test_retrieval_equals_scoring_everything(spark):
    rng = random.Random(8)
    bench = [(i, " ".join(f"v{int(rng.expovariate(0.05))}" for _ in range(rng.randint(3, 25)))) for i in range(60)]
    texts = [" ".join(f"v{int(rng.expovariate(0.05))}" for _ in range(rng.randint(1, 90))) for _ in range(60)]
    frame_ = items(spark, bench).selectExpr("item_id", "text", "item_id as row_hash")
    postings = [r.asDict() for r in decontaminate.item_terms(frame_).collect()]
    df = {}
    for p in postings:
        df[p["term"]] = df.get(p["term"], 0) + 1
    postings = [{**p, "df": df[p["term"]]} for p in postings]
    mean = np.mean([len(t.split()) for _, t in bench])
    index = decontaminate.build(frame_.toArrow(), pa.Table.from_pylist(postings), len(bench), mean)
    raw, starts = w.text_bytes(pa.array(texts))
    got = {}
    for text, item, score, *_ in decontaminate.search(index, raw, starts, 0.5, 0.0):
        got[text, item] = max(score, got.get((text, item), 0))
    weight = {(int(i), int(index.terms[t])): x for t in range(len(index.terms)) for i, x in
              zip(index.item[index.begin[t] : index.begin[t + 1]], index.impact[index.begin[t] : index.begin[t + 1]], strict=True)}
    expected = {}
    for t, text in enumerate(texts):
        hashes = w.Words(*w.text_bytes(pa.array([text])), is_word=decontaminate.LETTER).hashes()
        for low in range(0, len(hashes), index.stride):
            passage = hashes[low : low + 2 * index.stride]
            for i, length in enumerate(index.lengths):
                length = max(8, int(length))
                # stretches of twice the item's words, one from each of its lengths on
                for begin in range(0, max(1, len(passage) - length), length):
                    score = sum(weight.get((i, h), 0) for h in set(map(int, passage[begin : begin + 2 * length])))
                    if score >= 0.5:
                        expected[t, i] = max(score, expected.get((t, i), 0))
    assert got == pytest.approx(expected)
    assert len(got) > 20


@pytest.mark.parametrize("index_bytes", [1, 10**9])
def test_a_very_long_item_does_not_decide_for_short_ones(spark, monkeypatch, index_bytes):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", index_bytes)
    monkeypatch.setattr(decontaminate, "POSTINGS", 5_000)
    rng = random.Random(9)
    vocabulary = [f"u{i}" for i in range(6000)]
    long = " ".join(rng.choice(vocabulary) for _ in range(10_000))
    short = [(i, " ".join(f"s{i}x{j}" for j in range(15)) + f". answer a{i} b{i} c{i}") for i in range(12)]
    bench = items(spark, [(100, long), *short])
    noise = [rng.choice(vocabulary) for _ in range(9_000)]
    scattered, whole = list(noise), list(noise)
    # every three words of a short item, far from each other; and the item in one place
    words_ = short[3][1].replace(".", "").split()
    for n, j in enumerate(range(0, len(words_), 3)):
        at = 300 + n * 1400
        scattered[at:at] = words_[j : j + 3]
    whole[5000:5000] = short[4][1].split()
    docs = frame(spark, [(1, " ".join(scattered), "en", "s", 0), (2, " ".join(whole), "en", "s", 0), (3, f"before {long} after", "en", "s", 0)])
    found = decontaminate.contaminated(docs, bench)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(2, 4), (3, 100)}


def test_no_items_or_no_documents(spark, odd, nothing):
    bench = items(spark, [(1, "some question about nothing in particular. And its answer")])
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(nothing, bench).count() == 0
    assert decontaminate.contaminated(odd, bench).count() == 0
