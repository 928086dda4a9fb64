"""Shards of near equal bytes along a Hilbert curve over metadata, so that files can be skipped on several columns.

Dimensions are language, source and length (characters, in steps of half a power of two), each quantised to ``BITS`` bits:
categories by their rank among the distinct values (null last), spread over the whole range. Rows are sorted by their
cell's index on the curve, then by text, then by id, and the sequence is cut into runs of equal bytes.

Rows of equal text form a group that stands where its smallest id's row stands, so copies are neighbours whatever their
metadata. A group of at most 1 / ``WHOLE`` of a shard is never cut; larger ones are cut like single rows, so one group may
hold a third of all rows. A row weighs its text's UTF-8 bytes plus ``OVERHEAD``; null texts weigh as empty ones and form
one group with them. Repeated rows are rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm.running import with_starts
from riskweave.llm.tables import numbers
from riskweave.session import cut_lineage

SHARDS = 40
BITS = 5
WHOLE = 20
OVERHEAD = 16
GROUP = ["text_hash", "size", "text_crc32"]


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer coordinates below 2 ** bits: neighbours on it differ by one step.

    From the highest bit down, the coordinates' bits name a sub-cube in Gray code order; the rest of the coordinates is
    then turned into the orientation in which the curve runs through that sub-cube.
    """
    x = [np.asarray(c, np.int64).copy() for c in cells]
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for i in range(n):
            on = (x[i] >> bit) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(on, x[0] ^ below, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip = np.where((x[n - 1] >> bit) & 1 == 1, flip ^ ((1 << bit) - 1), flip)
    x = [c ^ flip for c in x]
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for c in x:
            out = (out << 1) | ((c >> bit) & 1)
    return out


def _cells(groups: DataFrame, column: str, bits: int) -> DataFrame:
    """(value, cell) of each distinct value: its rank, spread over the range. One row per value, not per document."""
    values = groups.select(F.col(column).alias(f"{column}_value")).distinct()
    rank = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col(f"{column}_value").asc_nulls_last())) - 1
    count = F.count(F.lit(1)).over(W.partitionBy(F.lit(0)))
    return values.select(f"{column}_value", F.floor(rank * (1 << bits) / count).cast("int").alias(f"{column}_cell"))


def with_curve(groups: DataFrame, bits: int = BITS) -> DataFrame:
    """Add ``curve`` to rows with ``lang``, ``source`` and ``chars``."""
    longest = F.least(F.floor(2 * F.log2(F.col("chars") + 1)), F.lit(2 * 32 - 1))
    out = groups.withColumn("chars_cell", F.floor(longest * (1 << bits) / 64).cast("int"))
    for c in ("lang", "source"):
        out = out.join(_cells(groups, c, bits), F.col(c).eqNullSafe(F.col(f"{c}_value")))
    kept = [c for c in groups.columns if c not in ("lang", "source", "chars")]
    cells = ["lang_cell", "source_cell", "chars_cell"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            curve = hilbert_index([numbers(batch.column(c)) for c in cells], bits)
            yield pa.record_batch([*[batch.column(c) for c in kept], pa.array(curve)], names=[*kept, "curve"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema.fields if f.name in kept)
    return out.select(*kept, *cells).mapInArrow(run, f"{schema}, curve long")


def _cut(start: Column, total: int, shards: int) -> Column:
    return F.least(F.floor(start * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int")


def assign(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, curve, shard, slot) of every row; slots of a shard count from 0 in curve order."""
    text = F.coalesce("text", F.lit(""))
    base = cut_lineage(
        docs.select(
            "doc_id",
            "lang",
            "source",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
            F.length(text).alias("chars"),
        )
    )
    first = F.min(F.struct("doc_id", "lang", "source")).alias("first")
    groups = base.groupBy(*GROUP).agg(first, F.max("chars").alias("chars"), F.sum("size").alias("bytes"))
    groups = cut_lineage(groups.select(*GROUP, "first.lang", "first.source", "chars", "bytes"))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    placed = with_starts(with_curve(groups, bits), [], ["curve", *GROUP], ["bytes"])
    placed = cut_lineage(placed.withColumn("whole", F.col("bytes") * (shards * WHOLE) <= total))
    rows = base.select("doc_id", *GROUP).join(placed, GROUP).withColumn("one", F.lit(1).cast("long"))
    rows = cut_lineage(rows)
    kept = ["doc_id", "size", "text_crc32", "text_hash", "curve", "one"]
    small = rows.filter("whole").select(*kept, F.col("before_bytes").alias("start"))
    large = with_starts(rows.filter("not whole"), GROUP, ["doc_id"], ["one"])
    large = large.select(*kept, (F.col("before_bytes") + F.col("before_one") * F.col("size")).alias("start"))
    cut = small.union(large).withColumn("shard", _cut(F.col("start"), total, shards))
    slotted = with_starts(cut, ["shard"], ["curve", "text_hash", "doc_id"], ["one"])
    return slotted.select("doc_id", "size", "text_crc32", "curve", "shard", F.col("before_one").alias("slot"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder per shard, rows in curve order, so row groups have narrow ranges in every dimension.

    ``options`` are those of ``assign``. Rows are told apart by all their columns; repeated rows keep their number.
    """
    named = docs.select("*", F.xxhash64(*docs.columns, *[F.col(c).isNull() for c in docs.columns]).alias("shard_row"))
    ids = named.withColumn("doc_id", F.col("shard_row"))
    places = cut_lineage(assign(ids, **options)).select(F.col("doc_id").alias("shard_row"), "shard", "slot")
    once = named.dropDuplicates(["shard_row"])
    rows = places.join(once, "shard_row").drop("shard_row")
    rows.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
