"""Stupid-backoff language-model scores of every document under the n-gram counts of all the others.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased. A word's score is c(context word) / c(context) for its longest context that
was seen with it, times ``ALPHA`` for each shortening; contexts are up to ``order - 1`` words of the same document. With no
context it is the word's share of all words, counting an unseen word once. A document's own occurrences are taken off all
counts, so a text cannot vouch for itself. Its score is the sum of the words' natural logarithms, and the mean of it.

The n-gram tables are partitioned by hash. Documents are dealt into buckets of about ``BUCKET_BYTES`` of text. A bucket sends
each partition the distinct n-grams it has there with its own counts (sorted, as differences: 6 bytes each instead of a row);
the partition adds up all buckets' counts, which is its slice of the count tables, and answers each bucket in the same order
with the other buckets' counts. The answers meet the bucket's exploded n-grams again. Texts travel packed, with a dictionary
from the first rows, which affects nothing but their size. A frequent n-gram is one entry per bucket, so none is hot. The numbers
of buckets and partitions follow the input's bytes.

N-grams are told apart by ``BITS`` bits of hash, all of them; among n distinct ones, one shares its hash with another with a
probability of about n / 2 ** BITS. Null and empty texts have no words and a null score. Repeated rows are documents of their own. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as w
from riskweave.llm.tables import WORD

ORDER = 3
ALPHA = 0.4
BITS = 64
BUCKET_BYTES = 8_000_000
PARTITION_BYTES = 16_000_000
SAMPLE, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 4000, 100_000


def squeeze(values: np.ndarray) -> bytes:
    """Integers as byte planes. Those below the mean's highest byte are as good as random and stay as they are."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    plain = (max(1, int(values.mean(dtype=np.float64))).bit_length() - 1) // 8 if len(values) else 0
    head = bytes([plain]) + len(values).to_bytes(4, "little")
    return head + planes[:plain].tobytes() + zstandard.compress(planes[plain:].tobytes(), 1)


def expand(data: bytes) -> np.ndarray:
    plain, n = data[0], int.from_bytes(data[1:5], "little")
    planes = data[5 : 5 + plain * n] + zstandard.decompress(data[5 + plain * n :])
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view("<u8").ravel()


def _sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data), dtype=np.uint64)


def keys(column: pa.ChunkedArray, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per order 1, 2, ...: the keys of all n-grams, by the word that ends them; texts' first words; words' places in their texts."""
    hashes, counts = [], [np.zeros(1, np.int64)]
    for _, _, raw, starts in w.pieces(column):
        found = w.Words(raw, starts)
        hashes.append(found.hashes())
        counts.append(np.diff(found.at))
    one = np.concatenate([np.zeros(0, np.uint64), *hashes])
    at = np.cumsum(np.concatenate(counts))
    place = np.arange(len(one)) - np.repeat(at[:-1], np.diff(at))
    out = []
    for n in range(1, order + 1):
        out.append(w.grams(one, at, n)[0] >> np.uint64(64 - BITS))
    return out, at, place


def _bucketed(docs: DataFrame) -> tuple[DataFrame, Callable, int, int]:
    """Documents in buckets, what unpacks their texts, the bits of a key that name its partition, and the number of all words."""
    counted = docs.agg(F.sum(F.octet_length("text")), F.sum(F.regexp_count("text", F.lit(WORD)))).first()
    total = counted[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("long").alias("bucket")
    parts = max(0, math.ceil(math.log2(max(1, total / PARTITION_BYTES))))
    packed, unpacked = _packed(docs.select("doc_id", "text", bucket))
    return packed.repartition(int(buckets), "bucket"), unpacked, parts, counted[1] or 0


def _packed(rows: DataFrame) -> tuple[DataFrame, Callable]:
    """The rows with their texts as zstd frames, and what makes texts of those again."""
    sample = rows.filter(F.length("text") > 0).select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).limit(SAMPLE).collect()
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, [r["text"].encode() for r in sample]).as_bytes()
    except zstandard.ZstdError:  # too few texts
        dictionary = b""

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            texts = [None if x is None else packer.compress(x) for x in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.binary()), batch["bucket"]], ["doc_id", "packed", "bucket"])

    def unpacked(column: pa.ChunkedArray) -> pa.ChunkedArray:
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        return pa.chunked_array([pa.array([None if x is None else unpacker.decompress(x) for x in column.to_pylist()], pa.binary())])

    return rows.mapInArrow(pack, "doc_id long, packed binary, bucket long"), unpacked


def scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, n_words, log_score, score) of every document; ``score`` is the mean per word."""
    dealt, unpacked, parts, all_words = _bucketed(docs)
    firsts = np.arange(1, 1 << parts, dtype=np.uint64) << np.uint64(BITS - parts if parts else 0)

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        mine, count = np.unique(np.concatenate(keys(unpacked(table["packed"]), order)[0]), return_counts=True)
        ends = np.concatenate([[0], np.searchsorted(mine, firsts), [len(mine)]])
        filled = np.flatnonzero(np.diff(ends))
        pick = [slice(ends[p], ends[p + 1]) for p in filled]
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()] * len(filled), pa.int64()),
                "part": pa.array(filled, pa.int64()),
                "grams": pa.array([squeeze(np.diff(mine[s], prepend=np.uint64(0))) for s in pick], pa.binary()),
                "counts": pa.array([squeeze(count[s]) for s in pick], pa.binary()),
            }
        )

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        lists = [_sorted(x.as_py()) for x in table["grams"]]
        every, place = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        count = np.concatenate([expand(x.as_py()) for x in table["counts"]]).astype(np.int64)
        np.add.at(total, place, count)
        ends = np.cumsum([len(x) for x in lists])
        found = [squeeze(x) for x in np.split(total[place] - count, ends[:-1])]
        return pa.table({"bucket": table["bucket"], "part": table["part"], "elsewhere": pa.array(found, pa.binary())})

    def score(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        grams, at, place = keys(unpacked(own["packed"]), order)
        n_words = np.diff(at)
        answers = answers.sort_by("part")
        elsewhere = np.concatenate([np.zeros(0, np.uint64), *[expand(x.as_py()) for x in answers["elsewhere"]]]).astype(np.int64)
        mine, count = np.unique(np.concatenate(grams), return_counts=True)
        totals = elsewhere + count
        text = np.repeat(np.arange(len(n_words)), n_words)
        others = []
        for n, gram in enumerate(grams, 1):
            there = np.flatnonzero(place >= n - 1)
            # occurrences in the same text
            pair = gram ^ w.scramble(text[there].astype(np.uint64), n)
            _, where, same = np.unique(pair, return_inverse=True, return_counts=True)
            left = np.zeros(len(text), np.int64)
            left[there] = totals[np.searchsorted(mine, gram)] - same[where]
            others.append(left)
        rest = np.maximum(all_words - n_words, 1)[text]
        log = np.log(np.maximum(others[0], 1) / rest)
        factor = np.where(place > 0, np.minimum(place, order - 1), 0) * np.log(alpha)
        result = log + factor
        for n in range(2, order + 1):
            context = np.zeros(len(text), np.int64)
            context[1:] = others[n - 2][:-1]
            hit = (place >= n - 1) & (others[n - 1] > 0)
            steps = np.minimum(place[hit], order - 1) - (n - 1)
            result[hit] = np.log(others[n - 1][hit] / context[hit]) + steps * np.log(alpha)
        total = np.bincount(text, result, len(n_words)) if len(text) else np.zeros(len(n_words))
        empty = n_words == 0
        return pa.table(
            {
                "doc_id": own["doc_id"],
                "n_words": pa.array(n_words, pa.int64()),
                "log_score": pa.array(total, pa.float64(), mask=empty),
                "score": pa.array(total / np.maximum(n_words, 1), pa.float64(), mask=empty),
            }
        )

    asked = dealt.groupBy("bucket").applyInArrow(ask, "bucket long, part long, grams binary, counts binary")
    answered = asked.groupBy("part").applyInArrow(answer, "bucket long, part long, elsewhere binary")
    schema = "doc_id long, n_words long, log_score double, score double"
    return dealt.groupBy("bucket").cogroup(answered.groupBy("bucket")).applyInArrow(score, schema)
