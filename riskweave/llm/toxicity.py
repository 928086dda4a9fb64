"""Toxicity of whole texts by a convolutional classifier over hashed word embeddings, trained in numpy.

A word is a run of letters and digits (any byte above 127 counts as a letter), lower-cased. Its vector is the sum of
the table rows that the hashes of the word and of its first bytes select. Filters of several widths slide over the word
vectors; each keeps its largest response in the text (zero if none is positive), and a logistic layer joins them.

Training takes every labelled document outside the held-out fifth; three quarters fit the network and the language
model, the rest calibrates. The texts are written once in shards along a fixed pseudo-random order. An epoch is a job: every
shard is passed through in small batches from the same network, and what the shards changed is averaged by blocks of table
rows. Word counts and thresholds are Spark aggregations over all rows. So only arrays of the network's fixed size
(and of the number of languages) meet in a task's memory or the driver's.

Thresholds are calibrated by language: a text's language is guessed from its words (naive Bayes over the same rows), and
the logit is shifted so that the language's threshold lands on 0.5. The language column is only a target of training.

Null and empty texts, and texts without a word, get the score of "no filter responds". Without labelled rows of both
classes every score is 0. Repeated documents are scored as often as they occur; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as w
from riskweave.llm.running import with_starts
from riskweave.llm.tables import held_out, numbers
from riskweave.session import cut_lineage

# Training texts of a shard; beyond the most shards, a shard takes more.
SHARD_TEXTS = 4096
MOST_SHARDS = 128
PLACES = 1 << 40  # steps of a text's place in the fixed pseudo-random order
CHUNK = 512  # texts that a task works on at once
FEW = 5  # texts of either label, below which no threshold is taken from them
BLOCK_ROWS = 4096  # rows of the table averaged together
ROWS = 1 << 18  # of the embedding table; its size is fixed
WIDTH = 12
FILTERS = {1: 6, 2: 4, 3: 4}  # filters of each width in words
PREFIXES = (4, 5)  # first bytes that share a row
EPOCHS = 8
BATCH = 32

LETTER = np.zeros(256, bool)
LETTER[48:58] = LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


@dataclass
class Model:
    table: np.ndarray  # (ROWS, WIDTH)
    filters: dict[int, np.ndarray]  # width -> (width, WIDTH, filters)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    languages: list[str]
    language_rows: np.ndarray  # (ROWS, languages): log probability of a word row
    shift: np.ndarray  # logit of each language's threshold


def word_rows(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of each distinct word, the distinct word at each place, and where each text begins."""
    found = w.Words(raw, starts, is_word=LETTER)
    if not len(found):
        return np.zeros((0, 1 + len(PREFIXES)), np.int64), np.zeros(0, np.int64), found.at
    full, first, at = np.unique(found.hashes(), return_index=True, return_inverse=True)
    low, end = found.first[first], found.last[first] + 1
    parts = [full] + [w.scramble(found.span_hash(low, np.minimum(low + n, end)), n) for n in PREFIXES]
    return (np.stack(parts, 1) % np.uint64(ROWS)).astype(np.int64), at, found.at


def responses(model: Model, rows: np.ndarray, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Largest response of every filter in every text, zero at least."""
    n_texts, n = len(begin) - 1, len(at)
    vectors = model.table[rows].sum(1) if len(rows) else np.zeros((0, WIDTH), np.float32)
    counts = np.diff(begin)
    out = []
    for width, filters in model.filters.items():
        pooled = np.zeros((n_texts, filters.shape[2]), np.float32)
        windows = n - width + 1
        if windows > 0:
            z = (vectors @ filters[0])[at[:windows]]
            for j in range(1, width):
                z += (vectors @ filters[j])[at[j : j + windows]]
            z += model.bias[width]
            full = np.flatnonzero(counts >= width)
            # the last windows of a text reach into the next one: end each stretch before them
            edges = np.stack([begin[full], begin[full + 1] - width + 1], 1).ravel()
            if len(edges) and edges[-1] == windows:
                edges = edges[:-1]
            if len(edges):
                pooled[full] = np.maximum(np.maximum.reduceat(z, edges, axis=0)[::2], 0)
        out.append(pooled)
    return np.concatenate(out, 1)


def language_scores(model: Model, rows: np.ndarray, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Mean log probability of each text's words by language (zero for texts without words)."""
    out = np.zeros((len(begin) - 1, len(model.languages)))
    if len(at):
        sums = np.zeros((len(at) + 1, len(model.languages)))
        np.cumsum(model.language_rows[rows[:, 1]][at], axis=0, out=sums[1:])
        out = (sums[begin[1:]] - sums[begin[:-1]]) / np.maximum(np.diff(begin), 1)[:, None]
    return out


def logits(model: Model, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Uncalibrated logit and guessed language of each text."""
    rows, at, begin = word_rows(raw, starts)
    return responses(model, rows, at, begin) @ model.out + model.out_bias, language_scores(model, rows, at, begin).argmax(1)


def _pass(model: Model, seen: dict[int, np.ndarray], touched: np.ndarray, texts: Sequence, y: np.ndarray, order: np.ndarray) -> None:
    """Adagrad on the logistic loss, once through the texts; only the words under a filter's largest response are touched.

    ``seen`` has the summed squares of the gradients by id of the array.
    """

    def step(a: np.ndarray, where, g: np.ndarray, rate: float = 0.1) -> None:
        seen[id(a)][where] += g * g
        a[where] -= rate * g / np.sqrt(seen[id(a)][where])

    for low in range(0, len(order), BATCH):
        chosen = order[low : low + BATCH]
        grads = {width: np.zeros_like(f) for width, f in model.filters.items()}
        bias = {width: np.zeros_like(b) for width, b in model.bias.items()}
        out, out_bias, row_ids, row_grads = np.zeros_like(model.out), 0.0, [], []
        bank = np.concatenate([f[j].T for f in model.filters.values() for j in range(len(f))])
        for t in chosen:
            rows, at = texts[t]
            vectors = model.table[rows].sum(1)
            answers, column = np.take(bank @ vectors.T, at, axis=1), 0
            features, places = [], []
            for width, f in model.filters.items():
                windows, n = len(at) - width + 1, f.shape[2]
                low_column, column = column, column + width * n
                if windows < 1:
                    features.append(np.zeros(n, np.float32))
                    places.append(None)
                    continue
                z = answers[low_column : low_column + n, :windows]
                for j in range(1, width):
                    z = z + answers[low_column + j * n : low_column + (j + 1) * n, j : j + windows]
                best = z.argmax(1)
                features.append(np.maximum(z[np.arange(n), best] + model.bias[width], 0))
                places.append(best)
            joined = np.concatenate(features)
            error = (1 / (1 + np.exp(-(joined @ model.out + model.out_bias))) - y[t]) / len(chosen)
            out += error * joined
            out_bias += error
            back = error * model.out * (joined > 0)
            base = 0
            for (width, f), best in zip(model.filters.items(), places, strict=True):
                g = back[base : base + f.shape[2]]
                base += f.shape[2]
                if best is None:
                    continue
                bias[width] += g
                for j in range(width):
                    word = at[best + j]
                    grads[width][j] += vectors[word].T * g
                    row_ids.append(rows[word])
                    row_grads.append(np.repeat((f[j] * g).T[:, None], rows.shape[1], 1))
        step(model.out, slice(None), out)
        model.out_bias -= 0.1 * out_bias
        for width in model.filters:
            step(model.filters[width], slice(None), grads[width], 0.05)
            step(model.bias[width], slice(None), bias[width], 0.05)
        if row_ids:
            ids, place = np.unique(np.concatenate([r.ravel() for r in row_ids]), return_inverse=True)
            total = np.zeros((len(ids), WIDTH), np.float32)
            np.add.at(total, place, np.concatenate([g.reshape(-1, WIDTH) for g in row_grads]))
            moved = np.abs(total).max(1) > 0
            step(model.table, ids[moved], total[moved])
            touched[ids[moved]] = True


def _arrays(model: Model) -> list[np.ndarray]:
    return [model.table, model.out, *model.filters.values(), *model.bias.values()]


def _unseen(model: Model) -> dict[int, np.ndarray]:
    return {id(a): np.full(a.shape, 1e-3, np.float32) for a in _arrays(model)}


def _fit_network(model: Model, texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rng: np.random.Generator) -> None:
    touched, seen = np.zeros(ROWS, bool), _unseen(model)
    for _ in range(EPOCHS):
        _pass(model, seen, touched, texts, y, rng.permutation(len(texts)))
    model.table[~touched, 1:] = 0  # what training never moved is noise


def _log_odds(found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Start of the first embedding column: log odds of a row's texts, drawn to zero where few texts have it.

    ``found`` has the texts with each row by label, ``sizes`` all texts by label.
    """
    rate = (found + 0.5) / (sizes + 1)
    total = found.sum(1)
    return (np.log(rate[:, 1] / rate[:, 0]) * total / (total + 3)).astype(np.float32)


def _threshold(score: np.ndarray, y: np.ndarray) -> float:
    """Logit with the best F1; halfway to the next score below."""
    order = np.argsort(-score, kind="stable")
    score, hits = score[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(score) + 1) + max(1, y.sum()))
    f1[:-1][score[:-1] == score[1:]] = -1  # equal scores stay together
    best = int(f1.argmax())
    return float((score[best] + score[best + 1]) / 2) if best + 1 < len(score) else float(score[best]) - 1.0


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(shard, place, checked, text, lang, toxic), written: every labelled text outside the held-out fifth, once per id and text.

    A quarter is ``checked``: it calibrates. Rows of a file are in the order of (shard, place).
    """
    known = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    free = docs.filter(~held_out() & F.col("doc_id").isNotNull())
    shards = min(MOST_SHARDS, max(1, -(-free.select("doc_id").join(known, "doc_id").count() // SHARD_TEXTS)))
    rows = (
        free.select("doc_id", "lang", "text", F.xxhash64("text").alias("text_hash"))
        .join(known, "doc_id")
        .groupBy("doc_id", "text_hash")
        .agg(F.min("lang").alias("lang"), F.max("toxic").alias("toxic"), F.min("text").alias("text"))
        .withColumn("place", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(10)), F.lit(PLACES)))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(11)), F.lit(shards)).cast("int"))
        .withColumn("checked", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(12)), F.lit(4)) == 0)
    )
    placed = rows.select("shard", "place", "checked", "text", "lang", "toxic", "doc_id", "text_hash")
    return cut_lineage(placed.repartitionById(shards, "shard").sortWithinPartitions("shard", "place", "doc_id", "text_hash"))


def _blank(languages: list[str], rng: np.random.Generator) -> Model:
    """A network before training."""
    shapes = {width: (width, WIDTH, n) for width, n in FILTERS.items()}
    table = np.empty((ROWS, WIDTH), np.float32)
    for low in range(0, ROWS, 1 << 14):  # in portions: drawn as doubles, kept as floats
        table[low : low + (1 << 14)] = rng.normal(0, 0.02, (1 << 14, WIDTH))
    return Model(
        table,
        {width: rng.normal(0, 0.3, s).astype(np.float32) for width, s in shapes.items()},
        {width: np.zeros(n, np.float32) for width, n in FILTERS.items()},
        rng.normal(0, 0.3, sum(FILTERS.values())).astype(np.float32),
        0.0,
        languages,
        np.zeros((ROWS, len(languages))),
        np.zeros(len(languages)),
    )


def _start(model: Model, words: np.ndarray, found: np.ndarray, sizes: np.ndarray) -> None:
    """The language model from its ``words`` (row, language), and the first embedding column from the texts with each row.

    ``words`` becomes the language model in place: the driver has no room for copies of it.
    """
    words += 1
    words /= words.sum(0)
    model.language_rows = np.log(words, out=words)
    model.table[:, 0] = _log_odds(found, sizes)
    for f in model.filters.values():
        f[:, 0] = np.abs(f[:, 0])
    model.out = np.abs(model.out)


def _parts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Table rows and places of each text's words; all words of a piece are hashed together."""
    for _, _, raw, starts in w.pieces(pc.utf8_lower(texts)):
        found = w.Words(raw, starts, is_word=LETTER)
        full, low, end = found.hashes(), found.first, found.last + 1
        parts = [full] + [w.scramble(found.span_hash(low, np.minimum(low + n, end)), n) for n in PREFIXES]
        rows = (np.stack(parts, 1) % np.uint64(ROWS)).astype(np.int64)
        for a, b in zip(found.at, found.at[1:], strict=False):
            _, first, at = np.unique(full[a:b], return_index=True, return_inverse=True)
            yield rows[a:b][first], at


def fit(rows: DataFrame | list, seed: int = 10) -> Model | None:
    """A model from ``training_rows``, or from a few (text, lang, toxic) at hand; None unless both labels occur."""
    return _fit_table(rows, seed) if isinstance(rows, DataFrame) else _fit_rows(rows, seed)


def _fit_rows(rows: list, seed: int) -> Model | None:
    y = np.array([int(t) for _, _, t in rows])
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    model = _blank(sorted({lang for _, lang, _ in rows if lang is not None}) or [""], rng)
    raw, starts = w.text_bytes(pc.utf8_lower(pa.array([t for t, _, _ in rows], pa.string())))
    parts = list(_parts(pa.array([t for t, _, _ in rows], pa.string())))
    words, found = np.zeros((ROWS, len(model.languages))), np.zeros((ROWS, 2))
    order = rng.permutation(len(rows))
    kept, checked = order[len(rows) // 4 :], order[: len(rows) // 4]
    for i in kept:
        found[np.unique(parts[i][0]), y[i]] += 1
        if rows[i][1] is not None and len(parts[i][1]):
            np.add.at(words[:, model.languages.index(rows[i][1])], parts[i][0][parts[i][1], 1], 1)
    _start(model, words, found, np.bincount(y[kept], minlength=2))
    _fit_network(model, [parts[i] for i in kept], y[kept], rng)
    if len(checked):
        judged = [logits(model, raw[starts[i] : starts[i + 1]], np.array([0, starts[i + 1] - starts[i]])) for i in checked]
        score, guess = np.array([f[0][0] for f in judged]), np.array([f[1][0] for f in judged])
        truth = y[checked]
        common = _threshold(score, truth) if truth.any() else 0.0
        for i in range(len(model.languages)):
            own = guess == i
            model.shift[i] = _threshold(score[own], truth[own]) if truth[own].any() and not truth[own].all() else common
    return model


def _fit_table(rows: DataFrame, seed: int) -> Model | None:
    sizes = {(r["checked"], r["toxic"], r["lang"]): r["n"] for r in rows.groupBy("checked", "toxic", "lang").agg(F.count("*").alias("n")).collect()}
    if len({toxic for _, toxic, _ in sizes}) < 2:
        return None
    model = _blank(sorted({lang for _, _, lang in sizes if lang is not None}) or [""], np.random.default_rng(seed))
    kept = rows.filter(~F.col("checked")).select("shard", "text", "lang", "toxic")
    of_label = np.array([sum(n for (checked, toxic, _), n in sizes.items() if not checked and toxic == label) for label in (0, 1)])
    _start(model, *_word_counts(kept, model.languages), of_label)
    seen, touched = _unseen(model), np.zeros(ROWS, bool)
    for epoch in range(EPOCHS):
        _epoch(kept, model, seen, touched, [seed, epoch])
    model.table[~touched, 1:] = 0  # what training never moved is noise
    del seen
    _calibrate(rows.filter("checked").select("text", "toxic"), model)
    return model


def _word_counts(kept: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, language): words; (row, label): texts with the row."""
    number = {lang: i for i, lang in enumerate(languages)}
    width = len(languages) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ROWS * width, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                part, cells = batch.slice(low, CHUNK), []
                for (rows, at), lang, toxic in zip(_parts(part.column(0)), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    cells.append(np.unique(rows) * width + len(languages) + toxic)
                    if lang is not None and len(at):
                        cells.append(rows[at, 1] * width + number[lang])
                cell, n = np.unique(np.concatenate(cells), return_counts=True)
                total[cell] += n
        cell = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    counted = kept.select("text", "lang", "toxic").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    (row, column), n = np.divmod(numbers(counted["cell"]), width), numbers(counted["n"])
    words, found = np.zeros((ROWS, len(languages))), np.zeros((ROWS, 2))
    of_words = column < len(languages)
    words[row[of_words], column[of_words]] = n[of_words]
    found[row[~of_words], column[~of_words] - len(languages)] = n[~of_words]
    return words, found


def _flat(arrays: Sequence[np.ndarray], last: float) -> np.ndarray:
    return np.concatenate([*[a.ravel() for a in arrays], [last]]).astype(np.float32)


def _epoch(kept: DataFrame, model: Model, seen: dict[int, np.ndarray], touched: np.ndarray, seed: Sequence[int]) -> None:
    """Every shard once through its texts from ``model``; then the mean of the changes, row by row over the shards that made some.

    The small arrays are the last block, as rows of one number. Changes reach the driver as Arrow batches, which are read
    where they lie: as rows they would be there several times over, in the JVM and here.
    """
    sent = kept.sparkSession.sparkContext.broadcast((replace(model, language_rows=None), [seen[id(a)] for a in _arrays(model)]))

    def changes(now: Model, squares: dict[int, np.ndarray], moved: np.ndarray) -> Iterator[pa.RecordBatch]:
        first, before = sent.value
        rows = np.flatnonzero(moved)
        delta, square = now.table[rows] - first.table[rows], squares[id(now.table)][rows] - before[0][rows]
        block = rows // BLOCK_ROWS
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        found = [(int(block[a]), rows[a:b], delta[a:b], square[a:b]) for a, b in zip(starts, np.append(starts[1:], len(rows)), strict=True)]
        small = _flat(_arrays(now)[1:], now.out_bias) - _flat(_arrays(first)[1:], first.out_bias)
        squared = _flat([squares[id(a)] for a in _arrays(now)[1:]], 0) - _flat(before[1:], 0)
        found.append((-1, np.arange(len(small)), small, squared))
        for number, *parts in found:
            yield pa.record_batch([pa.array([number]), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=["block", "rows", "delta", "square"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            of = numbers(batch.column(0))
            cuts = sorted({*range(0, batch.num_rows, CHUNK), *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist()})
            for low, high in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if shard != of[low]:
                    if shard is not None:
                        yield from changes(now, squares, moved)
                    shard = of[low]
                    first, before = sent.value
                    now = replace(
                        first, table=first.table.copy(), out=first.out.copy(),
                        filters={k: f.copy() for k, f in first.filters.items()}, bias={k: b.copy() for k, b in first.bias.items()},
                    )
                    squares = {id(a): b.copy() for a, b in zip(_arrays(now), before, strict=True)}
                    moved, rng = np.zeros(ROWS, bool), np.random.default_rng([*seed, int(shard)])
                text, toxic = batch.column(1).slice(low, high - low), numbers(batch.column(2))[low:high]
                for a, b, _, _ in w.pieces(text):  # long texts make smaller chunks
                    _pass(now, squares, moved, list(_parts(text.slice(a, b - a))), toxic[a:b], rng.permutation(b - a))
        if shard is not None:
            yield from changes(now, squares, moved)

    def mean(t: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in t["rows"]])
        ids, place, many = np.unique(rows, return_inverse=True, return_counts=True)
        out = []
        for c in ("delta", "square"):
            parts = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in t[c]]).reshape(len(rows), -1)
            total = np.zeros((len(ids), parts.shape[1]))
            np.add.at(total, place, parts)
            out.append((total / many[:, None]).astype(np.float32).tobytes())
        return pa.table([t["block"].slice(0, 1), *[pa.array([x], pa.binary()) for x in (ids.tobytes(), *out)]], names=["block", "rows", "delta", "square"])

    schema = "block long, rows binary, delta binary, square binary"
    changed = kept.select("shard", "text", "toxic").mapInArrow(run, schema).groupBy("block").applyInArrow(mean, schema).toArrow()
    sent.destroy()
    for block, *parts in zip(changed["block"].to_pylist(), changed["rows"], changed["delta"], changed["square"], strict=True):
        rows, delta, square = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(parts, (np.int64, np.float32, np.float32), strict=True))
        if block >= 0:
            model.table[rows] += delta.reshape(-1, WIDTH)
            seen[id(model.table)][rows] += square.reshape(-1, WIDTH)
            touched[rows] = True
            continue
        low = 0
        for a in _arrays(model)[1:]:
            a += delta[low : low + a.size].reshape(a.shape)
            seen[id(a)] += square[low : low + a.size].reshape(a.shape)
            low += a.size
        model.out_bias += float(delta[low])


def _calibrate(checked: DataFrame, model: Model) -> None:
    """The shift of each language: the threshold with the best F1 over the texts guessed as it, or over all texts, or none."""
    sent = checked.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, starts in w.pieces(pc.utf8_lower(batch.column(0))):
                z, guess = logits(sent.value, raw, starts)
                yield pa.record_batch([pa.array(guess.astype(np.int32)), pa.array(z.astype(np.float64)), batch.column(1).slice(low, high - low)], names=["guess", "z", "toxic"])

    judged = cut_lineage(checked.mapInArrow(run, "guess int, z double, toxic int"))
    sent.destroy()
    found = {r["guess"]: r["threshold"] for r in thresholds(judged.union(judged.select(F.lit(-1), "z", "toxic"))).collect()}
    for i in range(len(model.languages)):
        model.shift[i] = found.get(i, found.get(-1, 0.0))


def thresholds(judged: DataFrame) -> DataFrame:
    """(guess, threshold): the z with the best F1, halfway to the next z below, of each guess with ``FEW`` texts of both labels."""
    counts = judged.groupBy("guess", (-F.col("z")).alias("down")).agg(F.sum("toxic").cast("long").alias("hits"), F.count("*").alias("n"))
    counts = cut_lineage(counts)
    totals = counts.groupBy("guess").agg(F.sum("hits").alias("all_hits"), F.sum("n").alias("all_n"))
    totals = totals.filter((F.col("all_hits") >= FEW) & (F.col("all_n") - F.col("all_hits") >= FEW))
    f1 = 2 * (F.col("before_hits") + F.col("hits")) / (F.col("before_n") + F.col("n") + F.col("all_hits"))
    ranked = with_starts(counts, ["guess"], ["down"], ["hits", "n"]).join(F.broadcast(totals), "guess")
    best = ranked.groupBy("guess").agg(F.max(F.struct(f1.alias("f1"), (-F.col("down")).alias("z"))).alias("best")).select("guess", "best.z")
    below = counts.join(F.broadcast(best), "guess").filter(-F.col("down") < F.col("z")).groupBy("guess").agg(F.max(-F.col("down")).alias("below"))
    return best.join(below, "guess", "left").select("guess", F.coalesce((F.col("z") + F.col("below")) / 2, F.col("z") - 1).alias("threshold"))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, language_guess, score) of every row."""
    if model is None:
        return docs.select("doc_id", F.lit(None).cast("string").alias("language_guess"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array(m.languages, object)
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                part = batch.slice(begin, CHUNK)
                for low, high, raw, starts in w.pieces(pc.utf8_lower(part.column(1))):
                    z, guess = logits(m, raw, starts)
                    p = 1 / (1 + np.exp(-np.clip(z - m.shift[guess], -30, 30)))
                    yield pa.record_batch(
                        [part.column(0).slice(low, high - low), pa.array(names[guess], pa.string()), pa.array(p.astype(np.float64))],
                        names=["doc_id", "language_guess", "score"],
                    )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, language_guess string, score double")


def keep_clean(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose ``text`` scores below one half, with all their columns."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):  # texts are copied chunk by chunk
                part = batch.slice(low, CHUNK)
                found = [logits(m, raw, starts) for _, _, raw, starts in w.pieces(pc.utf8_lower(part.column(text)))]
                yield part.filter(pa.array(np.concatenate([z < m.shift[guess] for z, guess in found])))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, language_guess) of every document, by a model fitted on the labelled ones."""
    scored = score(docs, fit(training_rows(docs, labels)))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "language_guess"
    )
