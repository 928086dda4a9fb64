"""The toxicity model learns from every labelled text: rows, word counts, averaged shards, thresholds."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import frame, is_held_out

from riskweave.llm import toxicity


def rows_of(n, seed=8):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = [f"w{rng.randrange(200)}" for _ in range(rng.randint(3, 20))]
        toxic = rng.random() < 0.3
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["blarg", "snib"]))
        rows.append((i, " ".join(text), ("en", "fr", None)[i % 3], "s", 0))
        labels.append((i, int(toxic)))
    return rows, labels


def test_every_labelled_text_is_a_training_row(spark):
    rows, marks = rows_of(6000)
    labels = spark.createDataFrame([*marks, (7, None), (None, 1), (-5, 1)], "doc_id long, toxic int")
    docs = frame(spark, [*rows, rows[1], (rows[2][0], "another text", "en", "s", 0), (None, "no id", "en", "s", 0)])
    found = toxicity.training_rows(docs, labels).collect()
    wanted = [(r[1], t) for r, (i, t) in zip(rows, marks, strict=True) if not is_held_out(i)]
    wanted += [("another text", marks[2][1])] * (not is_held_out(2))
    assert sorted((r["text"], r["toxic"]) for r in found) == sorted(wanted)
    assert 0.2 < np.mean([r["checked"] for r in found]) < 0.3


def test_word_counts_are_those_of_all_texts(spark):
    rows, marks = rows_of(300)
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    kept = toxicity.training_rows(docs, labels).filter("not checked").repartition(3)
    words, found = toxicity._word_counts(kept, ["en", "fr"])
    wanted_words, wanted_found = np.zeros_like(words), np.zeros_like(found)
    for r in kept.collect():
        ((table, at),) = toxicity._parts(pa.array([r["text"]]))
        wanted_found[np.unique(table), r["toxic"]] += 1
        if r["lang"]:
            np.add.at(wanted_words[:, ["en", "fr"].index(r["lang"])], table[at, 1], 1)
    assert (words == wanted_words).all() and (found == wanted_found).all()


def test_several_shards_make_one_model(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_TEXTS", 200)
    monkeypatch.setattr(toxicity, "CHUNK", 70)
    rows, marks = rows_of(1500)
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    training = toxicity.training_rows(docs, labels)
    assert training.select("shard").distinct().count() > 4
    found = {r["doc_id"]: r for r in toxicity.predict(docs, labels).collect()}
    held = [(i, t) for i, t in marks if is_held_out(i)]
    assert sum(found[i]["predicted"] == t for i, t in held) >= 0.95 * len(held)
    again = {r["doc_id"]: r["score"] for r in toxicity.predict(docs.repartition(5), labels).collect()}
    assert again == pytest.approx({i: r["score"] for i, r in found.items()}, abs=1e-5)


def test_one_shard_moves_as_training_at_hand_does(spark):
    rows, marks = rows_of(60)
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    kept = toxicity.training_rows(docs, labels).filter("not checked").select("shard", "text", "toxic")
    local = kept.orderBy("shard").collect()
    one, two = (toxicity._blank(["en"], np.random.default_rng(1)) for _ in range(2))
    seen, touched = toxicity._unseen(one), np.zeros(toxicity.ROWS, bool)
    toxicity._epoch(kept, one, seen, touched, [3, 0])
    squares, moved = toxicity._unseen(two), np.zeros(toxicity.ROWS, bool)
    parts, y = list(toxicity._parts(pa.array([r["text"] for r in local]))), np.array([r["toxic"] for r in local])
    toxicity._pass(two, squares, moved, parts, y, np.random.default_rng([3, 0, 0]).permutation(len(y)))
    assert (touched == moved).all() and touched.any()
    for a, b in zip(toxicity._arrays(one), toxicity._arrays(two), strict=True):
        assert a == pytest.approx(b, abs=1e-5)
        assert seen[id(a)] == pytest.approx(squares[id(b)], abs=1e-5)
    assert one.out_bias == pytest.approx(two.out_bias)


def test_thresholds_equal_sorting_all_scores(spark):
    rng = random.Random(5)
    rows = [(g, rng.randrange(40) / 4 + 2 * t, t) for g in (-1, 0, 1) for t in [int(rng.random() < 0.3) for _ in range(300)]]
    rows += [(2, 1.0, 0), (3, 4.0, 1), (3, 2.0, 1)]
    found = {r[0]: r[1] for r in toxicity.thresholds(spark.createDataFrame(rows, "guess int, z double, toxic int").repartition(4)).collect()}
    assert set(found) == {-1, 0, 1}  # one label alone sets no threshold
    for g in found:
        z, y = (np.array([r[c] for r in rows if r[0] == g]) for c in (1, 2))
        assert found[g] == pytest.approx(toxicity._threshold(z, y))


def test_language_model_takes_the_place_of_its_word_counts():
    rng = np.random.default_rng(3)
    words, found = rng.integers(0, 9, (toxicity.ROWS, 6)).astype(float), rng.integers(0, 9, (toxicity.ROWS, 2)).astype(float)
    model, wanted = toxicity._blank(list("abcdef"), rng), np.log((words + 1) / (words + 1).sum(0))
    tracemalloc.start()
    toxicity._start(model, words, found, np.array([20, 10]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(model.language_rows, wanted)
    assert peak < words.nbytes
