"""SimHash fingerprints and all their near pairs by vantage-point trees.

A text is lower-cased (A-Z) and cut into words; its shingles are all runs of ``SHINGLE`` words, repeats included, joined by
one space (fewer words: the whole sequence as one). A bit of the fingerprint is set if it is set in over half of the
shingles' XXH64 (seed 42). Fingerprints within ``distance`` differing bits are linked; components of links are returned.

Of the 64 bits, cut into three blocks, two fingerprints within four bits differ in at most one bit of some block. Each
block has a vantage-point tree: an inner node holds a vantage point and a radius, and sends fingerprints to the inside or
outside by their Hamming distance in the block. By the triangle inequality a partner within one bit lies in the same branch
unless the distance is next to the radius; only then does a fingerprint visit the other branch too. The tree is fitted on a
bounded sample of the distinct fingerprints and cuts *all* of them into shards. A fingerprint is written to its home shard
and, as a visitor, to the later shards its ball touches, so a pair meets in the later of its two homes. Inside a shard the
same descent goes on, with vantage points of the shard, down to leaves that are compared over all 64 bits. Shards
above ``CELL`` members (many fingerprints that share a block's bits) are dealt out as pairs of parts.

Links inside a task are contracted to a spanning forest before they leave it, and equal fingerprints are one node, so a
group of m copies sends m edges at most.

Cases: a null text, or one without words, has fingerprint zero and is linked like any other; repeated rows and ids with
several texts are rows of their own; a component is named by its smallest id (null if no row has one). Other columns are
not looked at; an empty table gives an empty result. Texts are read whole, in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as w
from riskweave.llm.tables import arrow_bytes, components, numbers, run_starts, whole_runs
from riskweave.session import cut_lineage

SHINGLE, SEED = 4, 42
DISTANCE = 4
# Bits of a fingerprint by block. Three blocks leave one bit for the closest block of a pair within four.
BLOCKS = tuple(np.uint64(((1 << high) - 1) ^ ((1 << low) - 1)) for low, high in ((0, 21), (21, 42), (42, 64)))
# Distinct fingerprints that the trees are fitted on; a shard holds a 64th of the sample or more, 4,096 members in the table.
SAMPLE, LEAST_SAMPLE, SHARD = 16_384, 64, 4_096
# Members that one task compares with each other or with as many others, and sizes compared without going down further.
CELL, LEAF = 32_768, 64
# Shingles hashed at once, and bytes of text handed to a task at once; they bound memory only.
HASHED = 32_768
HANDED = 4_000_000


def joined_words(found: w.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a piece joined by one space, and where each begins and ends there."""
    length = found.last + 1 - found.first
    begin = np.cumsum(length + 1) - (length + 1)
    out = np.full(int((length + 1).sum()), 32, np.uint8)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(begin, length) + inside] = found.bytes[np.repeat(found.first, length) + inside]
    return out.tobytes(), begin, begin + length


def piece_fingerprints(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The fingerprint of every text of a piece."""
    found = w.Words(raw, starts)
    text, begin, end = joined_words(found)
    n = np.diff(found.at)
    shingles = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), shingles)
    first = found.at[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = np.minimum(first + SHINGLE, found.at[owner + 1]) - 1
    view, low, high = memoryview(text), begin[first], end[last] if len(last) else last
    ones = np.zeros((len(n), 64), np.int64)
    for at in range(0, len(owner), HASHED):
        spans = zip(low[at : at + HASHED].tolist(), high[at : at + HASHED].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(view[i:j], SEED) for i, j in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        part = owner[at : at + HASHED]
        runs = run_starts([part])
        ones[part[runs]] += np.add.reduceat(bits, runs, axis=0, dtype=np.int64)
    set_bits = (2 * ones > shingles[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits): the fingerprint of every text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, starts in w.pieces(batch.column(1)):
                bits = piece_fingerprints(raw, starts).view(np.int64)
                yield pa.record_batch([batch.column(0).slice(low, high - low), pa.array(bits)], names=["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, bits long")


def differing(one: np.ndarray, two: np.ndarray, block: np.uint64 | None = None) -> np.ndarray:
    """Hamming distances, within the bits of a block if one is given."""
    mixed = one ^ two
    return np.bitwise_count(mixed if block is None else mixed & block).astype(np.int64)


class Tree:
    """A vantage-point tree over one block's bits: per inner node a vantage point and a radius, in heap order."""

    def __init__(self, sample: np.ndarray, block: np.uint64, depth: int):
        self.block, self.depth = block, depth
        self.point = np.zeros((1 << depth) - 1, np.uint64)
        self.radius = np.zeros((1 << depth) - 1, np.int64)
        groups = {0: sample}
        for node in range(len(self.point)):
            here = groups.pop(node)
            # a node that no sampled fingerprint reaches still cuts, by its parent's vantage point
            self.point[node] = here[0] if len(here) else self.point[(node - 1) // 2]
            away = differing(here, self.point[node], block)
            self.radius[node] = _radius(away) if len(here) else 0
            groups[2 * node + 1], groups[2 * node + 2] = here[away <= self.radius[node]], here[away > self.radius[node]]

    def shards(self, bits: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, home) of every shard that lies within ``reach`` bits of each fingerprint, home or later than it."""
        row, node, home = np.arange(len(bits)), np.zeros(len(bits), np.int64), np.ones(len(bits), bool)
        for _ in range(self.depth):
            away = differing(bits[row], self.point[node], self.block)
            inside = away <= self.radius[node]
            crosses = inside & (away + reach > self.radius[node])  # from inside the later branch is the outer one
            back = ~home & ~inside & (away - reach <= self.radius[node])  # a visitor may turn either way
            forth = ~home & crosses
            over = home & crosses
            child = 2 * node + np.where(inside, 1, 2)
            row, node, home = (
                np.concatenate([row, row[over | forth], row[back]]),
                np.concatenate([child, 2 * node[over | forth] + 2, 2 * node[back] + 1]),
                np.concatenate([home, np.zeros(int((over | forth).sum() + back.sum()), bool)]),
            )
        return row, node - ((1 << self.depth) - 1), home


def _radius(away: np.ndarray) -> int:
    """The radius whose inside holds nearest to half, but not all if that can be."""
    tries = np.unique(away)
    if not len(tries):
        return 0
    inside = np.searchsorted(np.sort(away), tries, "right")
    return int(tries[np.argmin(np.abs(inside - len(away) / 2))])


def grow(nodes: DataFrame, count: int) -> list[Tree]:
    """One tree per block, fitted on at most ``SAMPLE`` of the ``count`` distinct fingerprints (bits)."""
    sample = nodes.select("bits").orderBy(F.xxhash64("bits"), "bits").limit(SAMPLE)
    points = np.array([r["bits"] for r in sample.collect()], np.int64).view(np.uint64)
    depth = max(0, min(count // SHARD, len(points) // LEAST_SAMPLE).bit_length() - 1)
    return [Tree(points, block, depth) for block in BLOCKS]


def members(nodes: DataFrame, trees: list[Tree], reach: int) -> DataFrame:
    """(tree, shard, home, bits): every fingerprint in its home shards and in the later ones that its ball touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = numbers(batch.column(0))
            for i, tree in enumerate(trees):
                row, shard, home = tree.shards(bits.view(np.uint64), reach)
                yield pa.record_batch(
                    [pa.array(np.full(len(row), i, np.int32)), pa.array(shard.astype(np.int32)), pa.array(home), pa.array(bits[row])],
                    names=["tree", "shard", "home", "bits"],
                )

    return nodes.select("bits").mapInArrow(run, "tree int, shard int, home boolean, bits long")


def forest(n: int, one: np.ndarray, two: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches along the edges, which go on from ``root`` if given."""
    root = np.arange(n) if root is None else root
    while (root[one] != root[two]).any():
        low = np.minimum(root[one], root[two])
        np.minimum.at(root, root[one], low)
        np.minimum.at(root, root[two], low)
        while (root[root] != root).any():
            root = root[root]
    return root


def shard_forest(bits: np.ndarray, left: np.ndarray, right: np.ndarray, block: np.uint64, reach: int, distance: int) -> np.ndarray:
    """The smallest of the fingerprints ``bits`` that each reaches by links of a ``left`` with a ``right`` one.

    The descent meets every pair of ``left`` and ``right`` places that are within ``reach`` bits in the block.
    """
    root = np.arange(len(bits))
    todo = [(left, right)]
    while todo:
        a, b = todo.pop()
        if not len(a) or not len(b):
            continue
        if len(a) > LEAF:
            point = bits[a[len(a) // 2]]
            near, far = differing(bits[a], point, block), differing(bits[b], point, block)
            radius = _radius(near)
            inside = near <= radius
            if 8 * min(inside.sum(), (~inside).sum()) >= len(a):
                todo += [(a[inside], b[far - reach <= radius]), (a[~inside], b[far + reach > radius])]
                continue
        step = max(1, (1 << 22) // len(b))
        for low in range(0, len(a), step):
            part = a[low : low + step]
            i, j = np.nonzero(np.bitwise_count(bits[part][:, None] ^ bits[b][None, :]) <= distance)
            apart = root[part[i]] != root[b[j]]
            if apart.any():
                root = forest(len(bits), part[i][apart], b[j][apart], root)
    return root


def links(cells: DataFrame, reach: int, distance: int) -> DataFrame:
    """(a, b): a spanning forest of the links within each cell (tree, shard, one, two) of members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["tree", "shard", "one", "two"]):
            columns = {c: numbers(t[c]) for c in t.column_names}
            starts = run_starts([columns[c] for c in ("tree", "shard", "one", "two")])
            for low, high in zip(starts, np.append(starts[1:], t.num_rows), strict=True):
                bits, home, part = (columns[c][low:high] for c in ("bits", "home", "part"))
                one, two = columns["one"][low], columns["two"][low]
                place = np.arange(len(bits))
                unsigned, block = bits.view(np.uint64), BLOCKS[columns["tree"][low]]
                if one == two:
                    root = shard_forest(unsigned, place[home], place, block, reach, distance)
                else:
                    root = shard_forest(unsigned, place[home & (part == one)], place[part == two], block, reach, distance)
                    more = shard_forest(unsigned, place[home & (part == two)], place[~home & (part == one)], block, reach, distance)
                    root = forest(len(bits), place, more, root)
                linked = np.flatnonzero(root != place)
                if len(linked):
                    yield pa.record_batch([pa.array(bits[root[linked]]), pa.array(bits[linked])], names=["a", "b"])

    dealt = cells.repartition("tree", "shard", "one", "two").sortWithinPartitions("tree", "shard", "one", "two")
    return dealt.mapInArrow(run, "a long, b long")


def cells(placed: DataFrame) -> DataFrame:
    """Members by cell: a shard whole, or every pair of its parts where it has over ``CELL`` members. Written members."""
    sizes = placed.groupBy("tree", "shard").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    with_part = placed.join(sizes, ["tree", "shard"]).withColumn("part", F.pmod(F.xxhash64("bits"), "parts").cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda x: F.struct(F.least(x, "part").alias("one"), F.greatest(x, "part").alias("two")),
    )
    return with_part.withColumn("pair", F.explode(pairs)).select("tree", "shard", "pair.one", "pair.two", "part", "home", "bits")


def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text)."""
    reach = DISTANCE // len(BLOCKS)
    with arrow_bytes(docs.sparkSession, HANDED):
        prints = cut_lineage(fingerprints(docs))
    nodes = cut_lineage(prints.groupBy("bits").agg(F.min("doc_id").alias("low")))
    trees = grow(nodes, nodes.count())
    placed = cut_lineage(members(nodes, trees, reach))
    edges = cut_lineage(links(cells(placed), reach, DISTANCE).distinct())
    found = components(edges)
    in_component = cut_lineage(
        nodes.join(found.withColumnRenamed("node", "bits"), "bits", "left").select("bits", "low", F.coalesce("component", "bits").alias("component"))
    )
    lowest = in_component.groupBy("component").agg(F.min("low").alias("component_id"))
    named = cut_lineage(in_component.join(lowest, "component").select("bits", "component_id"))
    return prints.join(named, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
