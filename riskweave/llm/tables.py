"""Shared steps of the operators: reading tables, ids that may repeat, whole groups inside Arrow batches, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.session import cut_lineage

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out() -> F.Column:
    """The fifth of the documents that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


# Bytes of text in a training sample.
MOST_BYTES = 64_000_000
# Steps of a row's place in the fixed pseudo-random order.
PLACES = 1 << 40


def sample_texts(
    docs: DataFrame, keys: DataFrame, strata: Sequence[str], per_stratum: int, most: int, most_bytes: int = MOST_BYTES
) -> list[tuple]:
    """A bounded training sample: (text, *strata) of the rows of ``docs`` that ``keys`` (doc_id, text_hash, size, *strata) names.

    At most ``per_stratum`` of each stratum, ``most`` in all and ``most_bytes`` of text, those that come first in a fixed
    pseudo-random order. Rows of a large stratum that are far behind in that order are left out before any are ranked, so a
    stratum is never gathered in one task; texts are fetched by id and hash once the sample is known. Rows without id
    are not sampled.
    """
    place = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(10)), F.lit(PLACES)).alias("place")
    known = cut_lineage(keys.filter(F.col("doc_id").isNotNull()).select("*", place))
    sizes = known.groupBy(*strata).agg(F.count("*").alias("n")).withColumnsRenamed({c: f"of_{c}" for c in strata})
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    # twice the rows wanted and a hundred more: fewer than wanted are practically never left
    ahead = F.col("place") <= F.lit(float(PLACES)) * (2 * per_stratum + 100) / F.col("n")
    rank = F.row_number().over(W.partitionBy(*strata).orderBy("place", "doc_id", "text_hash"))
    small = known.join(sizes, same).filter(ahead).withColumn("rank", rank).filter(F.col("rank") <= per_stratum)
    wanted: dict[tuple, list] = {}
    for r in small.orderBy("rank", "place", "doc_id", "text_hash").limit(most).collect():
        most_bytes -= r["size"]
        if most_bytes >= 0 or not wanted:
            wanted[r["doc_id"], r["text_hash"]] = [r[c] for c in strata]
    few = docs.sparkSession.createDataFrame(sorted(wanted), "doc_id long, text_hash long")
    found = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    found = found.join(F.broadcast(few), ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
    texts = {(r["doc_id"], r["text_hash"]): r["text"] for r in found.collect()}
    return [(texts[k], *wanted[k]) for k in sorted(wanted) if k in texts]


@contextmanager
def arrow_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs started inside hand Python batches of about ``most`` bytes, or of one longer row; the session's own size comes back."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def numbers(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int = 4000) -> Iterator[pa.Table]:
    """Tables of whole groups, about ``rows`` rows or more each, from batches sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        joined = pa.Table.from_batches(held).combine_chunks()
        last = run_starts([numbers(joined[k]) for k in keys])[-1]
        if last:
            yield joined.slice(0, last)
            held = joined.slice(last).to_batches()
            count = joined.num_rows - last
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def run_starts(keys: Sequence[np.ndarray]) -> np.ndarray:
    """Where each run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


# Edges that one task contracts; more of them take more tasks.
EDGES_PER_TASK = 1_000_000


def _contracted(edges: DataFrame) -> DataFrame:
    """(v, u): each node of the edges (a, b) that a task holds, with the smallest node it reaches inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        one, two = (np.concatenate([numbers(b.column(i)) for b in held]) for i in (0, 1))
        nodes, place = np.unique(np.concatenate([one, two]), return_inverse=True)
        one, two = place[: len(one)], place[len(one) :]
        root = np.arange(len(nodes))
        while (root[one] != root[two]).any():
            low = np.minimum(root[one], root[two])
            np.minimum.at(root, root[one], low)
            np.minimum.at(root, root[two], low)
            while (root[root] != root).any():
                root = root[root]
        member = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.record_batch([nodes[member], nodes[root[member]]], names=["v", "u"])

    tasks = -(-edges.count() // EDGES_PER_TASK)
    return cut_lineage(edges.select("a", "b").coalesce(max(1, tasks)).mapInArrow(run, "v long, u long"))


def _settled(stars: DataFrame) -> bool:
    """Whether every node has one root, and no root has one itself."""
    sides = stars.select(F.col("v").alias("node"), F.lit(1).alias("below")).union(stars.select("u", F.lit(0)))
    per = sides.groupBy("node").agg(F.sum("below").alias("roots"), F.min("below").alias("above"))
    return not per.agg(F.max((F.col("roots") > 1) | ((F.col("roots") > 0) & (F.col("above") == 0)))).first()[0]


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b), a written table or cheap to read.

    Each round first contracts the edges that share a partition, then alternates a large and a small star between
    partitions. Results are written out, so a lost executor repeats one step at most. A node's smallest neighbour comes from
    a partial aggregation and meets its edges in a join that adaptive execution can split, so a node with very many
    edges does not end in one task.
    """
    now = _contracted(edges.filter("a <> b"))
    for _ in range(rounds):
        if _settled(now):
            break
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cut_lineage(both.filter("v > u").join(least, "u").select("v", F.col("m").alias("u")).distinct())
        lowest = cut_lineage(large.groupBy("v").agg(F.min("u").alias("m")))
        moved = large.join(lowest, "v").select(F.col("u").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = _contracted(cut_lineage(moved.union(lowest.select(F.col("v").alias("a"), F.col("m").alias("b")))))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("u").alias("node")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
