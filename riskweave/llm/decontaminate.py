"""Benchmark decontamination: every passage of the training texts queries a BM25 index of the test items.

Words are runs of letters and digits, lower-cased. An item's answer is its last sentence (the last quarter of its words
if it has only one), its question the rest. The inverted index holds BM25 impacts divided by the item's score for itself, so
one threshold suits short and long items: 1 means that all of the item's words are there.

A passage is a window of twice the longest item's words; windows start every longest item, so an item that stands in a
text stands whole in some passage. A query runs as block-max WAND, on whole arrays of passages:

1. lists whose impacts together stay under ``LIGHT`` in every item can lift no item over the threshold alone; only
   passages with the other, essential lists are looked at, and must reach ``threshold - LIGHT`` with them;
2. items lie in blocks of ``BLOCK``; a list keeps its largest impact in each block, and a block is opened for a passage
   only if the sum of these maxima reaches that bound;
3. items of opened blocks are scored in full. All at or above the threshold are retrieved, none is cut off by a rank.

A retrieved pair counts when some stretch of the passage, of twice the item's own words, reaches the threshold by itself and
has the question's word 3-grams and the answer's at ``overlap`` or more each (words instead, where a part has fewer than
three). Stretches begin at every item's length, so an item that stands in a passage stands whole in one, and neither the
longest item nor the other items of its shard decide for a short one.

The index is built in tasks, one for each shard of about ``POSTINGS`` postings, and used by as many shards at once as
``INDEX_BYTES`` allow, so what a task or the driver holds does not grow with the benchmark; document frequencies and lengths
are those of all items. Null or empty items match nothing; null or empty
texts have no passage; repeated items are reported each. The result has one row per (doc_id, item_id), the best passage's.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as w
from riskweave.llm.tables import numbers
from riskweave.llm.toxicity import LETTER
from riskweave.session import cut_lineage

K1, B = 1.2, 0.75
THRESHOLD = 0.5
LIGHT = 0.25
OVERLAP = 0.6
BLOCK = 8
POSTINGS = 2_000_000
# Bytes of indexes that one scan of the documents uses.
INDEX_BYTES = 128_000_000
GRAM = 3
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".?!\n"]] = True

RESULT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _item(text: str | None) -> tuple[np.ndarray, int]:
    """Word hashes of an item and where its answer begins."""
    raw, starts = w.text_bytes(pc.utf8_lower(pa.array([text], pa.string())))
    found = w.Words(raw, starts, is_word=LETTER)
    n = len(found)
    if n == 0:
        return np.zeros(0, np.uint64), 0
    ends = np.flatnonzero(ENDS[raw])
    ends = ends[ends < found.first[-1]]
    answer = int(np.searchsorted(found.first, ends[-1])) if len(ends) else 0
    if answer == 0:
        answer = n - max(1, n // 4)
    return found.hashes(), answer


def _grams(hashes: np.ndarray) -> np.ndarray:
    """Distinct 3-gram hashes; words where there are fewer than three."""
    at = np.array([0, len(hashes)])
    return np.unique(w.grams(hashes, at, GRAM)[0] if len(hashes) >= GRAM else w.scramble(hashes, 5))


@dataclass
class Index:
    terms: np.ndarray  # sorted hashes
    begin: np.ndarray  # postings of a term: begin[t] to begin[t + 1]
    item: np.ndarray
    impact: np.ndarray
    block_begin: np.ndarray  # the same per block of items, with the largest impact
    block: np.ndarray
    block_max: np.ndarray
    essential: np.ndarray
    item_ids: list
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    lengths: np.ndarray
    stride: int


def item_terms(items: DataFrame) -> DataFrame:
    """(row, item_id, text, term, tf, words): the postings of all items, relationally."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes, _ = _item(text)
                terms, tf = np.unique(hashes, return_counts=True)
                n = len(terms)
                if n:
                    columns = [pa.array([key] * n, pa.int64()), terms.view(np.int64), tf.astype(np.int64), np.full(n, len(hashes))]
                    yield pa.record_batch(columns, names=["row_hash", "term", "tf", "words"])

    return items.select("row_hash", "text").mapInArrow(run, "row_hash long, term long, tf long, words long")


def build(items: pa.Table, postings: pa.Table, n_items: int, mean_words: float) -> Index:
    """Index of one shard: items (row_hash, item_id, text), postings (row_hash, term, tf, words, df)."""
    items = items.sort_by([("item_id", "ascending"), ("row_hash", "ascending")])
    rows = numbers(items["row_hash"])
    order = np.argsort(rows)
    item = order[np.searchsorted(rows[order], numbers(postings["row_hash"]))]
    term = numbers(postings["term"]).view(np.uint64)
    tf, words, df = (numbers(postings[c]).astype(float) for c in ("tf", "words", "df"))
    idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
    impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * words / mean_words))
    count = items.num_rows
    impact /= np.maximum(np.bincount(item, impact, count), 1e-12)[item]
    terms, term = np.unique(term, return_inverse=True)
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], impact[order]
    begin = np.searchsorted(term, np.arange(len(terms) + 1))
    # block maxima
    blocks = count // BLOCK + 1
    key, at = np.unique(term * blocks + item // BLOCK, return_inverse=True)
    block_max = np.zeros(len(key))
    np.maximum.at(block_max, at, impact)
    block_term, block = key // blocks, key % blocks
    # light lists: the longest first, as long as no item collects more than LIGHT from them
    essential = np.ones(len(terms), bool)
    mass = np.zeros(count)
    for t in np.argsort(-np.diff(begin), kind="stable"):
        own = slice(begin[t], begin[t + 1])
        if (mass[item[own]] + impact[own]).max() <= LIGHT:
            mass[item[own]] += impact[own]
            essential[t] = False
    parts = [_item(text) for text in items["text"].to_pylist()]
    lengths = np.array([len(h) for h, _ in parts], np.int64)
    return Index(
        terms, begin, item, impact, np.searchsorted(block_term, np.arange(len(terms) + 1)), block, block_max, essential,
        items["item_id"].to_pylist(),
        [_grams(h[:a]) for h, a in parts],
        [_grams(h[a:]) for h, a in parts],
        lengths,
        max(8, int(lengths.max(initial=0))),
    )


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of each [begin, end), and which range each comes from."""
    size = end - begin
    source = np.repeat(np.arange(len(size)), size)
    return np.arange(len(source)) - np.repeat(np.cumsum(size) - size, size) + begin[source], source


def search(index: Index, raw: np.ndarray, starts: np.ndarray, threshold: float, overlap: float) -> list[tuple]:
    """(text, item, score, question overlap, answer overlap) of every passage and item that count."""
    found = w.Words(raw, starts, is_word=LETTER)
    if not len(found) or not len(index.terms):
        return []
    hashes = found.hashes()
    term = np.searchsorted(index.terms, hashes).clip(max=len(index.terms) - 1)
    term[index.terms[term] != hashes] = -1
    stride, counts = index.stride, np.diff(found.at)
    # passages are numbered through: each text has one per started stride
    passages = -(-counts // stride)
    base = np.cumsum(passages) - passages
    hit = np.flatnonzero((term >= 0) & index.essential[term])
    text = np.searchsorted(found.at, hit, "right") - 1
    step = (hit - found.at[text]) // stride
    passage = base[text] + step
    again = step > 0  # also inside the passage that began one stride before
    passage = np.concatenate([passage, passage[again] - 1])
    hit_term = np.concatenate([term[hit], term[hit][again]])
    n_terms, n_blocks = len(index.terms), len(index.item_ids) // BLOCK + 1
    pairs = np.unique(passage * n_terms + hit_term)
    passage, hit_term = pairs // n_terms, pairs % n_terms
    bound = threshold - LIGHT
    # list maxima first, block maxima for what is left
    best = np.zeros(n_terms)
    full = np.flatnonzero(np.diff(index.block_begin))
    best[full] = np.maximum.reduceat(index.block_max, index.block_begin[:-1][full])
    reach = np.bincount(passage, best[hit_term], int(passages.sum()))
    keep = reach[passage] >= bound
    passage, hit_term = passage[keep], hit_term[keep]
    at, source = _ranges(index.block_begin[hit_term], index.block_begin[hit_term + 1])
    key, where = np.unique(passage[source] * n_blocks + index.block[at], return_inverse=True)
    opened = key[np.bincount(where, index.block_max[at], len(key)) >= bound]
    out = []
    # opened blocks of one passage stand together
    borders = np.append(np.flatnonzero(np.diff(opened // n_blocks, prepend=-1)), len(opened))
    for low, high in zip(borders, borders[1:], strict=False):
        p, blocks = opened[low] // n_blocks, opened[low:high] % n_blocks
        i = int(np.searchsorted(base, p, "right")) - 1
        first = found.at[i] + (p - base[i]) * stride
        own = slice(first, min(first + 2 * stride, found.at[i + 1]))
        here = np.unique(term[own])
        here = here[here >= 0]
        at, _ = _ranges(index.begin[here], index.begin[here + 1])
        at = at[np.isin(index.item[at] // BLOCK, blocks)]
        score = np.bincount(index.item[at], index.impact[at])
        words = hashes[own]
        for item in np.flatnonzero(score >= threshold):
            mine = at[index.item[at] == item]
            listed = np.searchsorted(index.begin, mine, "right") - 1
            best = _best_stretch(index, item, words, term[own], listed, index.impact[mine], threshold, overlap)
            if best:
                out.append((i, item, *best))
    return out


def _best_stretch(
    index: Index, item: int, words: np.ndarray, term: np.ndarray, listed: np.ndarray, impact: np.ndarray, threshold: float, overlap: float
) -> tuple[float, float, float] | None:
    """(score, question overlap, answer overlap) of the passage's best stretch for an item, if one counts.

    ``listed`` are the item's terms in the passage and ``impact`` what each adds to its score.
    """
    length, best = max(8, int(index.lengths[item])), None
    # only stretches that hold enough of the item's words are looked into
    order = np.argsort(listed)
    spot = np.searchsorted(listed[order], term).clip(max=len(listed) - 1)
    worth = np.where(listed[order][spot] == term, impact[order][spot], 0.0)
    so_far = np.concatenate([[0.0], np.cumsum(worth)])
    starts = np.arange(0, max(1, len(words) - length), length)
    ends = np.minimum(starts + 2 * length, len(words))
    for low, high in zip(starts, ends, strict=True):
        if so_far[high] - so_far[low] < threshold - 1e-9:
            continue
        part = words[low:high]
        score = float(impact[np.isin(listed, term[low:high])].sum())
        if score < threshold:
            continue
        grams = np.concatenate([w.grams(part, np.array([0, len(part)]), GRAM)[0], w.scramble(part, 5)])
        q, a = (float(np.isin(x, grams).mean()) if len(x) else 1.0 for x in (index.questions[item], index.answers[item]))
        if q >= overlap and a >= overlap:
            best = max(best or (0.0, 0.0, 0.0), (score, q, a))
    return best


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every document that holds a test item."""
    spark = docs.sparkSession
    rows = items.select("item_id", "text", F.xxhash64("item_id", "text").alias("row_hash")).dropDuplicates(["row_hash"])
    postings = cut_lineage(item_terms(rows))
    sizes = postings.groupBy("row_hash").agg(F.first("words").alias("words"), F.count("*").alias("n"))
    total = sizes.agg(F.count("*").alias("items"), F.avg("words").alias("mean"), F.sum("n").alias("postings")).first()
    if not total["items"]:
        return spark.createDataFrame([], RESULT)
    shards = -(-total["postings"] // POSTINGS)
    n_items, mean = total["items"], total["mean"]

    def run(key: tuple, some_items: pa.Table, some_postings: pa.Table) -> pa.Table:
        if not some_items.num_rows or not some_postings.num_rows:
            return pa.table({"shard": pa.array([], pa.int64()), "index": pa.array([], pa.binary())})
        index = zstandard.compress(pickle.dumps(build(some_items, some_postings, n_items, mean)), 1)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "index": pa.array([index], pa.binary())})

    shard = F.pmod("row_hash", F.lit(shards)).cast("long").alias("shard")
    with_df = postings.join(postings.groupBy("term").agg(F.count("*").alias("df")), "term").select("row_hash", "term", "tf", "words", "df", shard)
    by_shard = cut_lineage(rows.select("row_hash", "item_id", "text", shard)).groupBy("shard")
    indexes = cut_lineage(by_shard.cogroup(with_df.groupBy("shard")).applyInArrow(run, "shard long, index binary"))
    sizes = indexes.select("shard", F.length("index").alias("size")).orderBy("shard").collect()
    together, held = [[]], 0
    for r in sizes:
        if together[-1] and held + r["size"] > INDEX_BYTES:
            together.append([])
            held = 0
        together[-1].append(r["shard"])
        held += r["size"]
    result = None
    for some in together:
        packed = [r["index"] for r in indexes.filter(F.col("shard").isin(some)).orderBy("shard").collect()]
        found = _search_all(docs, packed, threshold, overlap)
        result = found if result is None else result.union(found)
    order = F.struct("score", "question_overlap", "answer_overlap")
    return result.groupBy("doc_id", "item_id").agg(F.max(order).alias("best")).select("doc_id", "item_id", "best.*")


def _search_all(docs: DataFrame, packed: list[bytes], threshold: float, overlap: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [pickle.loads(zstandard.decompress(p)) for p in shared.value]
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, _, raw, starts in w.pieces(pc.utf8_lower(batch.column(1))):
                for index in indexes:
                    hits = search(index, raw, starts, threshold, overlap)
                    if hits:
                        yield pa.record_batch(
                            [
                                pa.array([ids[low + i] for i, *_ in hits], pa.int64()),
                                pa.array([index.item_ids[j] for _, j, *_ in hits], pa.int64()),
                                *[pa.array([h[c] for h in hits], pa.float64()) for c in (2, 3, 4)],
                            ],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                        )

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
