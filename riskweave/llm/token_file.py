"""Token ids in fixed-width bit packing: every id takes the fewest bits that hold the vocabulary.

Documents are range-partitioned by id and encoded in order. A block holds whole documents of about ``BLOCK`` ids: the packed
ids (little-endian 64-bit words), the documents' ids and their lengths. Blocks are rows of Parquet files, so any store
that Spark writes to can hold them; files, and blocks in a file, ascend in document id. ``manifest`` gives the id count before each
file, so the place of any block is a sum of two numbers, and ids are unpacked with numpy, from any place in a block.

Each document ends with ``end_id``. Null texts are empty ones. Documents of one id keep all their rows, ordered by a hash of the
text. A tokenizer file with the rules ``WORD_RULES`` gives a text's ids as those of its words, one after the other, so each
distinct word is encoded once and looked up afterwards (``Encoder``); with a file of any other rules whole texts are encoded.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm import words as w
from riskweave.session import new_path

BLOCK = 1 << 16
KNOWN_WORDS = 1 << 20  # distinct words a task remembers; when full it starts again
JOINED_WORDS = 20_000  # words encoded in one call
PIECE_BYTES = 4_000_000


def pack(ids: np.ndarray, width: int) -> np.ndarray:
    """Ids below 2 ** width in 64-bit words, without gaps. The layout repeats after 64 / gcd(64, width) ids."""
    per, size = 64 // math.gcd(64, width), width // math.gcd(64, width)
    padded = np.zeros(-(-len(ids) // per) * per, np.uint64)
    padded[: len(ids)] = ids
    padded = padded.reshape(-1, per)
    out = np.zeros((len(padded), size), np.uint64)
    for j in range(per):
        word, shift = divmod(j * width, 64)
        out[:, word] |= padded[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= padded[:, j] >> np.uint64(64 - shift)
    return out.ravel()[: -(-len(ids) * width // 64)]


def unpack(packed: np.ndarray, width: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from number ``first`` on."""
    bit = (first + np.arange(count, dtype=np.uint64)) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    low = packed[word] >> shift
    over = shift + np.uint64(width) > 64
    next_word = packed[np.minimum(word + 1, len(packed) - 1)]
    high = np.where(over, next_word << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return ((low | high) & np.uint64((1 << width) - 1)).astype(np.uint32)


# The rules of tokenizer files under which a text can be encoded word by word.
WORD_RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
WORD_END = "</w>"


def splits_at_words(tokenizer) -> bool:
    """Whether a tokenizer has the rules that ``Encoder`` cuts words by, and no added token that a word could be part of."""
    rules = json.loads(tokenizer.to_str())
    same = all(rules[name] == wanted for name, wanted in WORD_RULES.items()) and not rules["truncation"] and not rules["padding"]
    added = [t["content"] for t in rules["added_tokens"]]
    return same and rules["model"].get("end_of_word_suffix") == WORD_END and all(a[:1] == "<" and not re.search(r"\s", a) for a in added)


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Encoder:
    """Ids of whole texts from a tokenizer file, by distinct words where its rules allow that.

    Words of ASCII and U+00C0 to U+00FF are cut further where letters meet other signs, as the tokenizer does itself, and
    A-Z lower-cased; a word with an apostrophe, a ``<`` or another character goes to the tokenizer as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = splits_at_words(self.tokenizer)
        size = self.tokenizer.get_vocab_size()
        self.ends_word = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = token.endswith(WORD_END)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _units(self, raw: np.ndarray, starts: np.ndarray) -> tuple[w.Words, np.ndarray]:
        """The pieces that are looked up, and which of them are letters only."""
        found = w.Words(raw, starts, lower=False)
        n = len(raw)
        lead = raw == 0xC3
        second = np.zeros(n, bool)
        second[1:] = lead[:-1]
        latin = lead.copy()
        latin[:-1] &= (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        letter = _LETTER[raw] | latin
        letter[1:] |= latin[:-1]
        odd = (raw == 39) | (raw == 60) | ((raw >= 128) & ~letter)
        before = np.zeros(n + 1, np.int64)
        np.cumsum(odd, out=before[1:])
        plain = before[found.last + 1] == before[found.first]
        inside = np.zeros(n + 1, np.int8)
        inside[found.first[plain]] += 1
        np.add.at(inside, found.last[plain] + 1, -1)
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
        found.bytes = np.where(inside, w.LOWER[raw], raw)
        turn = np.zeros(n, bool)
        turn[1:] = inside[1:] & inside[:-1] & (letter[1:] != letter[:-1])
        turn[found.first] = True
        first = np.flatnonzero(turn)
        word = np.searchsorted(found.first, first, "right") - 1
        last = found.last[word]
        same = np.flatnonzero(word[1:] == word[:-1])
        last[same] = first[same + 1] - 1
        found.first, found.last = first, last
        found.at = np.searchsorted(first, starts)
        return found, plain[word] & letter[first]

    def _learn(self, hashes: np.ndarray, texts: list[str], letters: np.ndarray) -> None:
        ids: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for low in range(0, len(texts), JOINED_WORDS):
            joined = [i for i in range(low, min(low + JOINED_WORDS, len(texts))) if letters[i]]
            got = np.array(self.tokenizer.encode(" ".join(texts[i] for i in joined), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[got]) + 1
            if len(ends) == len(joined):  # one word end per word
                for i, part in zip(joined, np.split(got, ends[:-1]), strict=True):
                    ids[i] = part
            else:
                letters[joined] = False
        single = np.flatnonzero(~letters)
        for i, e in zip(single, self.tokenizer.encode_batch([texts[i] for i in single], add_special_tokens=False), strict=True):
            ids[i] = np.array(e.ids, np.uint32)
        if len(self.known) + len(hashes) > KNOWN_WORDS:
            self._forget()
        sizes = np.array([len(x) for x in ids], np.int64)
        begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(sizes) - sizes])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known)
        self.known, self.begin, self.size = known[order], begin[order], np.concatenate([self.size, sizes])[order]
        self.ids = np.concatenate([self.ids, *ids])

    def encode(self, raw: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and how many each text has."""
        if not self.by_word:
            data = raw.tobytes()
            texts = [data[a:b].decode() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            found = [[*e.ids, end_id] for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        units, letters = self._units(raw, starts)
        hashes, first, place = np.unique(units.hashes(), return_index=True, return_inverse=True)
        spot = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        there = spot < len(self.known)
        new[there] = self.known[spot[there]] != hashes[there]
        if len(self.known) + new.sum() > KNOWN_WORDS:
            self._forget()
            new[:] = True
        if new.any():
            data, picked = units.bytes.tobytes(), first[new]
            texts = [data[a:b].decode() for a, b in zip(units.first[picked].tolist(), (units.last[picked] + 1).tolist(), strict=True)]
            self._learn(hashes[new], texts, letters[picked].copy())
        spot = np.searchsorted(self.known, hashes)[place]
        # an end mark behind the last unit of every text
        begin = np.insert(self.begin[spot], units.at[1:], len(self.ids))
        size = np.insert(self.size[spot], units.at[1:], 1)
        flat = np.append(self.ids, np.uint32(end_id))
        out = flat[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        total = np.concatenate([[0], np.cumsum(size)])
        edges = units.at + np.arange(len(units.at))
        return out, np.diff(total[edges])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


BLOCKS = "file_no int, block_no long, before long, n_ids long, width int, packed binary, doc_ids array<long>, sizes array<long>"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int, block: int = BLOCK) -> None:
    """Encode ``docs`` (doc_id, text) into block files under ``path``. ``tokenizer`` is a file that every task can open."""
    width = max(1, (vocabulary - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        number = before = 0
        file_no = None
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

        def rows(everything: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, number, before
            if not held:
                return
            ids, sizes = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            names = pa.concat_arrays([h[2] for h in held])
            ends = np.cumsum(sizes)
            low = done = 0
            while low < len(sizes):
                high = max(low + 1, int(np.searchsorted(ends, done + block, "right")))
                if high == len(sizes) and not everything:
                    break
                part = ids[done : ends[high - 1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "file_no": pa.array([file_no], pa.int32()),
                        "block_no": [number],
                        "before": [before],
                        "n_ids": [len(part)],
                        "width": pa.array([width], pa.int32()),
                        "packed": [pack(part, width).astype("<u8").tobytes()],
                        "doc_ids": pa.array([names.slice(low, high - low).to_pylist()], pa.list_(pa.int64())),
                        "sizes": pa.array([sizes[low:high]], pa.list_(pa.int64())),
                    }
                )
                number, before, done, low = number + 1, before + len(part), int(ends[high - 1]), high
            held = [(ids[done:], sizes[low:], names.slice(low))] if low < len(sizes) else []

        for batch in batches:
            if batch.num_rows:
                file_no = batch.column(2)[0].as_py()
            for low, high, raw, starts in w.pieces(batch.column(1), PIECE_BYTES):
                ids, sizes = encoder.encode(raw, starts, end_id)
                held.append((ids, sizes, batch.column(0).slice(low, high - low)))
                yield from rows(False)
        yield from rows(True)

    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.select("doc_id", "text", F.spark_partition_id().alias("file_no"))
    numbered.mapInArrow(run, BLOCKS).write.parquet(path)


def manifest(blocks: DataFrame) -> DataFrame:
    """(file_no, file_start): ids in all files before; one row per file."""
    per = blocks.groupBy("file_no").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("file_no").rowsBetween(W.unboundedPreceding, -1))
    return per.select(F.col("file_no").alias("of_file"), F.coalesce(before, F.lit(0)).alias("file_start"))


def read_documents(blocks: DataFrame) -> DataFrame:
    """(file_no, doc_id, place, n_tokens, ids_crc32): each document's place in its file and a checksum of its unpacked ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["packed"], "<u8"), row["width"], 0, row["n_ids"]).astype("<u4")
                sizes = np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                data = memoryview(ids.tobytes())
                sums = [zlib.crc32(data[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array([row["file_no"]] * len(sizes), pa.int32()), pa.array(row["doc_ids"], pa.int64())]
                columns += [pa.array(x) for x in (row["before"] + ends - sizes, sizes, np.array(sums, np.int64))]
                yield pa.record_batch(columns, names=["file_no", "doc_id", "place", "n_tokens", "ids_crc32"])

    return blocks.mapInArrow(run, "file_no int, doc_id long, place long, n_tokens long, ids_crc32 long")


def encoded_documents(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from files written for the purpose."""
    spark = docs.sparkSession
    path = new_path(spark, "token-blocks")
    write(docs, path, tokenizer, end_id, vocabulary)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    found = read_documents(blocks).join(manifest(blocks), F.col("file_no") == F.col("of_file"))
    return found.select("doc_id", (F.col("file_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
