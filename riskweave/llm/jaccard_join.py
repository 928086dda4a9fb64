"""N-gram Jaccard join by several global token orders.

A text's set holds its distinct ``k``-word shingles (lower-cased A-Z; fewer words: the whole sequence as one; none: an
empty set, linked with nothing). Two sets of similarity ``num / den`` or more share a token among the first
``n - ceil(n * num / den) + 1`` of each set, in *any* fixed order of all tokens. Candidates must do so in every one of
``ORDERS`` orders; the candidate pairs of the orders are intersected before the sets are compared.

* All orders begin with the same fixed share of the tokens, by their exact document frequency, and differ in how they rank
  tokens of one frequency; the other tokens follow by hash. Frequencies are counted in buckets by the token's hash, which
  grow in number with the input. A token of one document joins nothing: only shared ones make buckets, and a set whose
  prefix has no shared token in some order is done.
* Equal sets are one class, found by a 64-bit hash of the set; only classes are compared.
* Links inside a large group are not spelled out: each bucket of a prefix token first links its members with one of them,
  components are formed, and after that only pairs of different components are looked at. Components are therefore exact
  while a group of m near copies takes m comparisons, not m * m.
* Buckets are cut into blocks of ``BLOCK`` rows and compared block against block, so none has to fit a task.
* A row carries its set's histogram over ``BINS`` bins: the sum of the smaller counts is never below the size of the
  intersection, so pairs under the bound are dropped without their texts. What remains is compared on the whole texts.

Null and empty texts are rows of the result with ``n_shingles`` 0 and their own id as component. Rows are told apart by a
64-bit hash of id and text, so repeated rows and ids that stand for several texts are linked like any others and every row
is returned; a component is named by its smallest id (null if it has none). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as w
from riskweave.llm.tables import components, numbers, run_starts, whole_runs
from riskweave.session import cut_lineage

# The share of all tokens whose frequencies are counted, as a multiple of a prefix's share of a set.
COUNTED = 2.5
# Tokens that one task counts.
BUCKET_TOKENS = 500_000
# Bytes of text in a piece, and pieces in a file, each a row of up to about as many bytes.
PIECE_BYTES = 1_000_000
PIECES_OF_A_FILE = 64
FULL = (1 << 32) - 1  # frequencies above rank alike
# Cells of the filter that keeps unwanted texts out of a shuffle; a full one lets more texts through.
FILTER_CELLS = 1 << 20
BINS = 256
BLOCK = 512
# Rows of whole cells that a task holds at once, or one cell.
HELD_ROWS = 1_000
ORDERS = 2
# Bucket rows of one family that a task compares together.
GROUP_ROWS = 8_192
# Pairs compared by histogram at once; bounds memory only.
SLAB = 10_000
# Prefix tokens of pairs looked through at once; bounds memory only.
LOOKED_THROUGH = 200_000


def need(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """The least intersection that a set of size n has with any set linked to it."""
    return -(-n * num // den)


def _sets(raw: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    found = w.Words(raw, starts)
    return w.sets(found.hashes(), found.at, k)


def _set_hash(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(w.scramble(values, 21), out=total[1:])
    return w.scramble(total[at[1:]] - total[at[:-1]] + w.scramble(np.diff(at).astype(np.uint64), 22)).view(np.int64)


def _prefix_size(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return (n - need(n, num, den) + 1) * (n > 0)


def _counted(values: np.ndarray, num: int, den: int) -> np.ndarray:
    """The tokens that all orders put first and whose document frequencies are counted: a fixed share of all tokens, some
    times a prefix's share of a set."""
    share = min(1.0, COUNTED * (den - num) / den)
    return (w.scramble(values, 41) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


def pieces(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """One row per piece of text: its rows with set sizes, set hashes and histograms, and the tokens that prefixes can use.

    These are the counted ones, or all of a set that has fewer counted ones than its prefix is long. Equal sets of a piece
    keep their tokens once.
    """
    schema = pa.schema(
        [("piece", pa.int64())]
        + [(c, pa.list_(pa.int64())) for c in ("row", "doc_id", "n", "set_hash")]
        + [("hist", pa.list_(pa.binary())), ("kept", pa.list_(pa.int64())), ("tokens", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high, raw, starts in w.pieces(batch.column(2), PIECE_BYTES):
                values, at = _sets(raw, starts, k)
                n, rows = np.diff(at), high - low
                text = np.repeat(np.arange(rows), n)
                cell = text * BINS + (w.scramble(values, 31) % np.uint64(BINS)).astype(np.int64)
                hist = np.minimum(np.bincount(cell, minlength=rows * BINS), 65535).astype(np.uint16).reshape(rows, BINS)
                hashes = _set_hash(values, at)
                first = np.zeros(rows, bool)
                first[np.unique(hashes, return_index=True)[1]] = True
                counted = _counted(values, num, den)
                enough = np.bincount(text[counted], minlength=rows) >= _prefix_size(n, num, den)
                wanted = first[text] & (counted | ~enough[text])
                lists = [batch.column(0).slice(low, rows), batch.column(1).slice(low, rows), pa.array(n), pa.array(hashes)]
                lists += [pa.array([_packed(h) for h in hist], pa.binary()), pa.array(np.bincount(text[wanted], minlength=rows))]
                whole = pa.array([0, rows], pa.int32())
                yield pa.record_batch(
                    [pa.array([number]), *[pa.ListArray.from_arrays(whole, c) for c in lists], pa.array([values[wanted].tobytes()], pa.binary())], schema=schema
                )
                number += 1

    return docs.select("row", "doc_id", "text").mapInArrow(
        run, "piece long, row array<long>, doc_id array<long>, n array<long>, set_hash array<long>, hist array<binary>, kept array<long>, tokens binary"
    )


def shared_tokens(pieced: DataFrame, num: int, den: int) -> DataFrame:
    """(piece, tokens, frequencies): the counted tokens of each piece that two or more rows of all pieces have.

    Each piece sends every distinct token once, with its count, to the token's bucket; a bucket adds up and answers. So a
    token of very many documents is one entry per piece, and no table of all tokens exists anywhere.
    """
    total = pieced.agg(F.sum(F.length("tokens"))).first()[0] or 0
    count = max(1, -(-total // (8 * BUCKET_TOKENS)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, tokens in zip(batch.column(0), batch.column(1), strict=True):
                values = np.frombuffer(tokens.as_buffer(), np.uint64)
                values, times = np.unique(values[_counted(values, num, den)], return_counts=True)
                if not len(values):
                    continue
                bucket = (w.scramble(values, 51) % np.uint64(count)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, values, times = bucket[order], values[order], np.minimum(times[order], FULL).astype(np.uint32)
                starts = run_starts([bucket])
                ends = np.append(starts[1:], len(bucket))
                yield pa.record_batch(
                    [
                        pa.array(bucket[starts]),
                        pa.array(np.full(len(starts), piece.as_py())),
                        pa.array([values[i:j].tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary()),
                        pa.array([times[i:j].tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary()),
                    ],
                    names=["bucket", "piece", "tokens", "times"],
                )

    def answer(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["tokens"]]
        times = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in t["times"]])
        _, place = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.minimum(np.bincount(place, weights=times)[place], FULL).astype(np.uint32)
        rows, low = [], 0
        for piece, part in zip(t["piece"], parts, strict=True):
            own = total[low : low + len(part)]
            low += len(part)
            if (own > 1).any():
                rows.append((piece.as_py(), part[own > 1].tobytes(), own[own > 1].tobytes()))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["piece", "tokens", "frequencies"])

    asked = pieced.select("piece", "tokens").mapInArrow(ask, "bucket long, piece long, tokens binary, times binary")
    return asked.groupBy("bucket").applyInArrow(answer, "piece long, tokens binary, frequencies binary")


def signatures(pieced: DataFrame, answers: DataFrame, num: int, den: int, orders: int) -> DataFrame:
    """(set_hash, n, hist, prefix_i): the shared tokens in each order's prefix, of the sets that have some in every order.

    A set whose prefix in some order has only tokens of its own is linked with no other set.
    """
    names = ["set_hash", "n", "hist", *[f"prefix_{i}" for i in range(orders)]]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in names]
        known = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in right["tokens"]] or [np.zeros(0, np.uint64)])
        frequency = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in right["frequencies"]] or [np.zeros(0, np.uint32)])
        order = np.argsort(known)
        known, frequency = known[order], frequency[order].astype(np.uint64)
        for i in range(left.num_rows):
            values = np.frombuffer(left["tokens"][i].as_buffer(), np.uint64)
            kept, n = numbers(left["kept"][i].values), numbers(left["n"][i].values)
            text = np.repeat(np.arange(len(n)), kept)
            counted = _counted(values, num, den)
            rank = np.where(counted, np.uint64(1), np.uint64(FULL + 1))
            if len(known):
                place = np.minimum(np.searchsorted(known, values), len(known) - 1)
                found = counted & (known[place] == values)
                rank[found] = frequency[place[found]]
            size, begin = _prefix_size(n, num, den), np.cumsum(kept) - kept
            nth, chosen, active = np.arange(len(values)) - np.repeat(begin, kept), [], kept > 0
            for j in range(orders):
                at = np.lexsort((values, w.scramble(values, 100 + j), rank, text))
                at = at[(nth < size[text]) & (rank[at] > 1)]
                chosen.append(at)
                active &= np.bincount(text[at], minlength=len(n)) > 0
            rows = np.flatnonzero(active)
            columns[0].append(left["set_hash"][i].values.take(pa.array(rows)))
            columns[1].append(pa.array(n[rows]))
            columns[2].append(left["hist"][i].values.take(pa.array(rows)))
            for j, at in enumerate(chosen):
                at = at[active[text[at]]]
                ends = np.concatenate([[0], np.cumsum(np.bincount(text[at], minlength=len(n))[rows])])
                columns[3 + j].append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[at].view(np.int64))))
        kinds = [pa.int64(), pa.int64(), pa.binary()] + [pa.list_(pa.int64())] * orders
        return pa.table([pa.chunked_array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "set_hash long, n long, hist binary, " + ", ".join(f"prefix_{i} array<long>" for i in range(orders))
    own = pieced.select("piece", "n", "set_hash", "hist", "kept", "tokens")
    return own.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(run, schema)


def buckets(signed: DataFrame, order: int) -> DataFrame:
    """(token, size, lead, node): the classes of each prefix token that two or more classes have, and the smallest of them."""
    rows = signed.select(F.explode(f"prefix_{order}").alias("token"), "node")
    shared = cut_lineage(rows.groupBy("token").agg(F.count("*").alias("size"), F.min("node").alias("lead")).filter("size > 1"))
    return cut_lineage(rows.join(shared, "token").select("token", "size", "lead", "node"))


def _packed(hist: np.ndarray) -> bytes:
    """A histogram in 4, 8 or 16 bits a bin, told apart by the length."""
    most = hist.max()
    if most < 16:
        return (hist[::2] | hist[1::2] << 4).astype(np.uint8).tobytes()
    return hist.astype(np.uint8).tobytes() if most < 256 else hist.tobytes()


def _histograms(column: pa.Array) -> np.ndarray:
    out = np.zeros((len(column), BINS), np.uint16)
    for i, h in enumerate(column):
        b = h.as_buffer()
        if len(b) == BINS // 2:
            pairs = np.frombuffer(b, np.uint8)
            out[i, ::2], out[i, 1::2] = pairs & 15, pairs >> 4
        else:
            out[i] = np.frombuffer(b, np.uint8 if len(b) == BINS else np.uint16)
    return out


def _may_link(i: np.ndarray, j: np.ndarray, n: np.ndarray, hist: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs the sizes and histograms leave open; ``n`` of i and j in any order."""
    keep = den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j])
    i, j, where = i[keep], j[keep], np.flatnonzero(keep)
    common = np.minimum(hist[i], hist[j]).sum(1, dtype=np.int64)
    # a count that the histogram cannot hold leaves the pair open
    full = (hist[i].max(1, initial=0) == 65535) | (hist[j].max(1, initial=0) == 65535)
    return where[(den * common >= num * (n[i] + n[j] - common)) | full]


def _blocks(column: str = "size") -> F.Column:
    return F.ceil(F.col(column) / BLOCK).cast("int")


def star_candidates(rows: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): each member of a bucket's block with the block's smallest node, if the bounds leave it open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["token", "block"], HELD_ROWS):
            node, n = numbers(t["node"]), numbers(t["n"])
            starts = run_starts([numbers(t["token"]), numbers(t["block"])])
            head = np.repeat(starts, np.diff(np.append(starts, len(node))))
            other = np.flatnonzero(head != np.arange(len(node)))
            hist = _histograms(t["hist"])
            for low in range(0, len(other), SLAB):
                i = other[low : low + SLAB]
                keep = i[_may_link(i, head[i], n, hist, num, den)]
                yield pa.record_batch([node[head[keep]], node[keep]], names=["a", "b"])

    block = F.pmod(F.xxhash64("node", "token"), _blocks()).cast("int")
    dealt = rows.join(described, "node").withColumn("block", block).repartition("token", "block").sortWithinPartitions("token", "block", "node")
    return dealt.select("token", "block", "node", "n", "hist").mapInArrow(run, "a long, b long").distinct()


def _first_common(prefix: pa.ListArray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest prefix token that the rows i and j of each pair have in common; there is one."""
    offsets, values = numbers(prefix.offsets), numbers(prefix.values)
    many = np.cumsum(offsets[i + 1] - offsets[i] + offsets[j + 1] - offsets[j])
    cuts = np.searchsorted(many, np.arange(LOOKED_THROUGH, many[-1], LOOKED_THROUGH))
    cuts = np.unique([0, *cuts, len(i)])
    return np.concatenate([_first_common_of(offsets, values, i[a:b], j[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])


def _first_common_of(offsets: np.ndarray, values: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    pair, token = [], []
    for side in (i, j):
        many = offsets[side + 1] - offsets[side]
        pair.append(np.repeat(np.arange(len(side)), many))
        token.append(values[np.repeat(offsets[side] - np.cumsum(many) + many, many) + np.arange(many.sum())])
    pair, token = np.concatenate(pair), np.concatenate(token)
    order = np.lexsort((token, pair))
    pair, token = pair[order], token[order]
    twice = np.flatnonzero((pair[1:] == pair[:-1]) & (token[1:] == token[:-1]))
    return token[twice][np.unique(pair[twice], return_index=True)[1]]


def cross_candidates(rows: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of one bucket in different components that the bounds leave open. ``rows`` has ``comp``.

    Buckets of one family mostly have the same smallest node. Their blocks are dealt to tasks by that node, and a node's
    block is the same in all of them. A family of more than ``GROUP_ROWS`` rows is dealt by its tokens too, so that a group
    has a fixed bound. Wherever else a pair meets, it leaves only the group of the first token that its prefixes share.
    ``described`` has the ``prefix`` of the rows' order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["lead", "salt", "one", "two"], HELD_ROWS):
            cells = run_starts([numbers(t[c]) for c in ("lead", "salt", "one", "two")])
            cell = np.repeat(np.arange(len(cells)), np.diff(np.append(cells, t.num_rows)))
            at = t["at"].combine_chunks()
            row = np.repeat(np.arange(t.num_rows), at.value_lengths())
            token, block = (numbers(at.flatten().field(c)) for c in ("token", "block"))
            order = np.lexsort((numbers(t["n"])[row], token, cell[row]))
            row, token, block = row[order], token[order], block[order]
            n, comp, one, two = (numbers(t[c])[row] for c in ("n", "comp", "one", "two"))
            starts = run_starts([cell[row], token])
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(row))))
            # rows of a group ascend in n: partners of i stand behind it, as far as their size allows
            limit = n * den // num
            width = int(n.max()) + 2
            end = np.searchsorted(group * width + n, group * width + np.minimum(limit, width - 1), "right")
            many = np.maximum(end - np.arange(len(row)) - 1, 0)
            node, first, own = np.unique(numbers(t["node"]), return_index=True, return_inverse=True)
            own = own[row]
            once = t.select(["hist", "n", "prefix"]).take(pa.array(first))
            hist, size, prefix = _histograms(once["hist"]), numbers(once["n"]), once["prefix"].combine_chunks()
            found, here = np.zeros((0, 2), np.int64), np.unique(token)
            totals = np.cumsum(many)
            low = 0
            while low < len(row):
                high = max(low + 1, int(np.searchsorted(totals, (totals[low - 1] if low else 0) + SLAB, "right")))
                i = np.repeat(np.arange(low, high), many[low:high])
                base = np.repeat(totals[low:high] - many[low:high], many[low:high]) - (totals[low - 1] if low else 0)
                j = i + 1 + np.arange(len(i)) - base
                right = (comp[i] != comp[j]) & ((one[i] == two[i]) | (block[i] != block[j]))
                pairs = np.unique(np.sort(np.stack([own[i[right]], own[j[right]]], 1), axis=1), axis=0)
                pairs = pairs[_may_link(pairs[:, 0], pairs[:, 1], size, hist, num, den)]
                if len(pairs):
                    pairs = pairs[np.isin(_first_common(prefix, pairs[:, 0], pairs[:, 1]), here)]
                found = np.unique(np.concatenate([found, pairs]), axis=0)
                low = high
            yield pa.record_batch([node[found[:, 0]], node[found[:, 1]]], names=["a", "b"])

    mixed = rows.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("token")
    # a power of two, so that a node's block is the same in buckets of like size
    blocks = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("size") / BLOCK, F.lit(1.0))))).cast("int")
    with_each = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda x: F.struct(F.least(x, F.col("block")).alias("one"), F.greatest(x, F.col("block")).alias("two")),
    )
    open_ = cut_lineage(rows.join(mixed, "token"))
    salts = open_.groupBy("lead").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("salts"))
    cells = ["lead", "salt", "one", "two"]
    dealt = (
        open_.join(salts, "lead")
        .withColumn("salt", F.pmod(F.xxhash64("token"), "salts").cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("pair", F.explode(with_each))
        .select("lead", "salt", "pair.one", "pair.two", "node", "comp", F.struct("token", "block").alias("at"))
        .groupBy(*cells, "node", "comp")
        .agg(F.collect_list("at").alias("at"))
        .join(described, "node")
        .select(*cells, "node", "comp", "at", "n", "hist", "prefix")
        .repartition(*cells)
        .sortWithinPartitions(*cells)
    )
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _only_wanted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose number may be wanted, by a filter of at most ``FILTER_CELLS`` entries; the join that follows settles it."""
    cell = F.pmod(F.col("row"), F.lit(FILTER_CELLS)).cast("int").alias("cell")
    return docs.select("row", "text", cell).join(F.broadcast(ids.select(cell).distinct()), "cell", "left_semi").drop("cell")


def linked(docs: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The candidate pairs (a, b) whose whole texts meet the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                sides = []
                for name in ("text_a", "text_b"):
                    found = [_sets(raw, starts, k) for _, _, raw, starts in w.pieces(part.column(name))]
                    sides.append((np.concatenate([v for v, _ in found]), np.concatenate([np.diff(at) for _, at in found])))
                row = np.concatenate([np.repeat(np.arange(part.num_rows), n) for _, n in sides])
                value = np.concatenate([v for v, _ in sides])
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                twice = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
                common = np.bincount(row[1:][twice], minlength=part.num_rows)
                union = sides[0][1] + sides[1][1] - common
                yield part.select(["a", "b"]).filter(pa.array(den * common >= num * union))

    pairs = cut_lineage(pairs)
    ids = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    texts = _only_wanted(docs, ids).join(ids, "row").dropDuplicates(["row"])
    rows = (
        pairs.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return cut_lineage(rows.mapInArrow(run, "a long, b long"))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, orders: int = ORDERS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    pieced = cut_lineage(pieces(docs, k, num, den), file_rows=PIECES_OF_A_FILE)
    per_doc = pieced.select(F.inline(F.arrays_zip("row", "doc_id", F.col("n").alias("n_shingles"), "set_hash")))
    classes = cut_lineage(
        per_doc.filter("n_shingles > 0").groupBy("set_hash").agg(F.min("row").alias("node"), F.min("doc_id").alias("low"))
    )
    signed = signatures(pieced, shared_tokens(pieced, num, den), num, den, orders)
    signed = cut_lineage(signed.dropDuplicates(["set_hash"]).join(classes.select("set_hash", "node"), "set_hash").drop("set_hash"))
    described = signed.select("node", "n", "hist")

    by_order = [buckets(signed, i) for i in range(orders)]
    near = linked(docs, star_candidates(by_order[0], described, num, den), k, num, den)
    merged = components(near)

    candidates = None
    for i, rows in enumerate(by_order):
        with_prefix = signed.select("node", "n", "hist", F.col(f"prefix_{i}").alias("prefix"))
        with_comp = rows.join(merged, "node", "left").withColumn("comp", F.coalesce("component", "node"))
        found = cross_candidates(with_comp.select("token", "size", "lead", "node", "comp"), with_prefix, num, den)
        candidates = found if candidates is None else candidates.intersect(found)
    rest = linked(docs, candidates, k, num, den)
    final = components(near.union(rest))
    in_component = classes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = cut_lineage(in_component.groupBy("component").agg(F.min("low").alias("component_id")))
    named = cut_lineage(in_component.join(lowest, "component").select("set_hash", "component_id"))
    key = F.when(F.col("n_shingles") > 0, F.col("set_hash"))  # empty sets join nothing
    return (
        per_doc.withColumn("set_hash", key)
        .join(named, "set_hash", "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )
