"""Hard negatives by exact inner products, scored with the Four-Russians method.

Components become the integers floor(256 * x). A row keeps them as bit planes: for every bit of the integers (two's
complement) and every group of eight dimensions one byte. For an anchor, the sums of all 256 subsets of a group's eight
components are tabulated once; a candidate's byte picks its subset's sum, the groups of a plane are added, and the planes
are shifted and added, the sign plane negative. The result is the full inner product, without rounding.

Rows are cut into parts along (label, id), anchors into blocks by hash, and a task holds one part and one block, so its
size does not depend on the table or on how rows are spread over labels. The first pass meets an anchor with the parts that
hold its label and keeps the part's best positives; the second meets it with all parts, for the score windows of its
positives. Only a part's best rows leave a task; the best of all parts are ranked afterwards.

Cases: rows with a null label, a null vector or a null or non-finite component take no part. Rows that agree in id, label
and vector are counted before they are scored and ranked as the separate rows that they are; an anchor's own row is no
positive of it, a copy of it is one. Every copy of an anchor has its results. A null id is no anchor and comes last among
ties. Vectors of different lengths are filled with zeros. Components too large for exact 64-bit scores are refused with an
error. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.operators.ordered import SLICE, slice_by
from riskweave.session import cut_lineage

SCALE = 256
GROUP = 8
# Candidates of one task, and how many parts a smaller table is cut into.
PART_ROWS, LEAST_ROWS, PARTS = 65_536, 4_096, 64
BLOCK_ANCHORS = 4_096
# Anchors tabulated at once and candidates looked up at once; bound memory only.
TABLED, LOOKED_UP = 128, 2_048
NO_ID = (1 << 63) - 1
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    ).filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))


def shape(rows: DataFrame) -> tuple[int, int]:
    """(groups of eight dimensions, bits) that hold every component of ``rows``."""
    most, longest = rows.agg(
        F.max(F.array_max(F.transform("embedding", lambda x: F.abs(F.floor(x * SCALE).cast("double"))))), F.max(F.size("embedding"))
    ).first()
    groups, most = -(-(longest or 0) // GROUP) or 1, most or 0
    if 100 * most * most * groups * GROUP >= 2**62:
        raise ValueError(f"components up to {most / SCALE:.4g} are too large for exact 64-bit scores")
    return groups, int(most).bit_length() + 1


def packed(values: np.ndarray, bits: int) -> np.ndarray:
    """(rows, bits, groups) bytes of an integer matrix whose columns are a multiple of eight."""
    planes = (values[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8).reshape(len(values), bits, -1, GROUP), axis=3, bitorder="little")[..., 0]


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The integers behind ``packed``."""
    rows, bits, groups = planes.shape
    weight = 1 << np.arange(bits, dtype=np.int64)
    weight[-1] = -weight[-1]
    set_bits = np.unpackbits(planes[..., None], axis=3, bitorder="little").reshape(rows, bits, groups * GROUP)
    return np.einsum("rbd,b->rd", set_bits.astype(np.int64), weight)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): the sum of every subset of each group's components."""
    rows, width = anchors.shape
    out = np.zeros((width // GROUP, 1 << GROUP, rows), kind)
    for g in range(width // GROUP):
        for j in range(GROUP):
            out[g, 1 << j : 2 << j] = out[g, : 1 << j] + anchors[:, GROUP * g + j].astype(kind)
    return out


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(candidates, anchors) inner products from the candidates' planes and the anchors' subset sums."""
    rows, bits, groups = planes.shape
    out = np.zeros((rows, tables.shape[2]), tables.dtype)
    for b in range(bits - 1, -1, -1):
        out <<= 1
        for g in range(groups):
            found = tables[g].take(planes[:, b, g], axis=0)
            if b == bits - 1:
                out -= found
            else:
                out += found
    return out


def _planes(column: pa.ChunkedArray, bits: int, groups: int) -> np.ndarray:
    joined = b"".join(part.as_py() for part in column)
    return np.frombuffer(joined, np.uint8).reshape(len(column), bits, groups)


def _best(score: np.ndarray, ids: np.ndarray, open_: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` open rows that come first, by score downwards and then id."""
    at = np.flatnonzero(open_)
    if len(at) > k:
        least = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= least]
    return at[np.lexsort((ids[at], -score[at]))][:k]


def bit_planes(rows: DataFrame, groups: int, bits: int) -> DataFrame:
    """(vec_id, label, planes, n): the distinct rows as bit planes, with how often each occurs."""

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * SCALE).astype(np.int64)
            values = np.zeros((batch.num_rows, groups * GROUP), np.int64)
            row = np.repeat(np.arange(batch.num_rows), counts)
            values[row, np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = flat
            data = packed(values, bits).reshape(batch.num_rows, -1)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * data.shape[1]
            planes = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())])
            yield pa.record_batch([batch.column(0), batch.column(1), planes], names=["vec_id", "label", "planes"])

    return rows.mapInArrow(run, "vec_id long, label long, planes binary").groupBy("vec_id", "label", "planes").agg(F.count("*").alias("n"))


def _cells(candidates: DataFrame, anchors: DataFrame, blocks: int, choose, schema: str, groups: int, bits: int) -> DataFrame:
    """What ``choose`` yields for every anchor and part that meet in a cell (part, block)."""
    kind = np.int32 if groups * GROUP << (2 * bits - 2) < 2**31 else np.int64
    columns = [f.split()[0] for f in schema.split(", ")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            left = left.sort_by("vec_id")
            planes = _planes(left["planes"], bits, groups)
            side = {c: left[c].to_numpy() for c in ("vec_id", "label", "n")}
            for low in range(0, right.num_rows, TABLED):
                some = right.slice(low, TABLED)
                own = _planes(some["planes"], bits, groups)
                tables = subset_sums(unpacked(own), kind)
                found = np.concatenate([scores(planes[i : i + LOOKED_UP], tables) for i in range(0, len(planes), LOOKED_UP)])
                rows = some.select([c for c in some.column_names if c != "planes"]).to_pylist()
                for i, anchor in enumerate(rows):
                    same = side["vec_id"] == anchor["vec_id"]
                    same[same] = (planes[same] == own[i]).all((1, 2)) & (side["label"][same] == anchor["label"])
                    out += choose(anchor, found[:, i].astype(np.int64), side, same)
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] or [pa.array([], pa.int64())] * len(columns), names=columns)

    spread = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return spread.groupBy("part", "block").cogroup(cut_lineage(anchors).groupBy("part", "block")).applyInArrow(run, schema)


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group, with their ``rank``; a row that occurs n times counts as n rows."""
    order = W.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k))))).drop("copy", "n")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, label, embedding).

    For each row that ``is_anchor`` (a condition on ``vec_id``) names and each of its best ``positives`` of the same label:
    the best ``negatives`` rows of other labels whose score is ``low`` to ``high`` hundredths of the positive's.
    """
    rows = usable(vectors)
    groups, bits = shape(rows)
    once = cut_lineage(bit_planes(rows, groups, bits))
    count = once.count()
    if not count:
        return vectors.sparkSession.createDataFrame([], RESULT)
    parts = -(-count // min(PART_ROWS, max(LEAST_ROWS, -(-count // PARTS))))
    place = F.xxhash64("vec_id", "label", "planes")
    sliced = slice_by(once.withColumn("row", place), "label", "row", "vec_id", slices=parts)
    candidates = sliced.select(F.col(SLICE).alias("part"), "vec_id", "label", "n", "planes")

    chosen = sliced.filter(is_anchor & (F.col("vec_id") != NO_ID))
    blocks = max(1, -(-chosen.count() // BLOCK_ANCHORS))
    chosen = chosen.withColumn("block", F.pmod("row", F.lit(blocks)).cast("int")).select("row", "block", "vec_id", "label", "planes", "n")

    def best_positives(anchor, score, side, same):
        left = side["n"] - same
        at = _best(score, side["vec_id"], (side["label"] == anchor["label"]) & (left > 0), positives)
        return [(anchor["row"], anchor["vec_id"], side["vec_id"][j], score[j], left[j]) for j in at]

    parts_of = candidates.select("part", "label").distinct()
    kept = "row long, anchor_id long, vec_id long, score long, n long"
    meets = chosen.drop("n").join(parts_of, "label")
    first = _ranked(_cells(candidates, meets, blocks, best_positives, kept, groups, bits), ["anchor_id", "row"], positives)
    first = cut_lineage(first.select("row", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    def best_negatives(anchor, score, side, same):
        other, out = side["label"] != anchor["label"], []
        for p in anchor["wanted"]:
            at = _best(score, side["vec_id"], other & (100 * score >= low * p) & (100 * score <= high * p), negatives)
            out += [(anchor["row"], anchor["vec_id"], p, side["vec_id"][j], score[j], side["n"][j]) for j in at]
        return out

    wanted = first.groupBy("row", "anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("wanted"))
    everywhere = (
        chosen.drop("n")
        .join(wanted.withColumnRenamed("anchor_id", "vec_id"), ["row", "vec_id"])
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    )
    kept = "row long, anchor_id long, positive_score long, vec_id long, score long, n long"
    second = _ranked(_cells(candidates, everywhere, blocks, best_negatives, kept, groups, bits), ["anchor_id", "row", "positive_score"], negatives)
    copies = chosen.select("row", F.col("vec_id").alias("anchor_id"), F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))

    def named(c: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c))

    return (
        first.join(second, ["row", "anchor_id", "positive_score"])
        .join(copies, ["row", "anchor_id"])
        .select("anchor_id", named("positive_id").alias("positive_id"), "rank", named("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
