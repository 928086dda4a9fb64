"""The prefix trie of conversations, built as burst tries.

A conversation is a path of turn ids (64-bit hashes of role and text). A container holds the suffixes of all conversations
under one head, a prefix of turn ids, and may hold ``CONTAINER_ROWS`` turns. One with more is burst: its head becomes a node
of the trie above, and each next turn id heads a container of its own. How many turns every possible head has below it is
counted in one aggregation, which decides all bursts at once, however deep they go. Heads are told apart by depth and a
128-bit sum of position-dependent hashes, whose running totals along a conversation no single task has to make.

What remains are containers of bounded size: each is sorted and swept into nodes in one task, a stack holding the path from
its head to the present turn. The nodes above, whose containers burst, are aggregated over their members; what a subtree
adds up is credited to one member of each node, summed along that member's path, and then over the members.

Cases: a null role or text is an empty one; turns are ordered by turn (null first), then role and text, and repeated rows are
turns of their own. Rows without conv_id belong to no conversation. A conversation without turns is a member of the root.
Other columns are not looked at; an empty table has no nodes. Hashing a node's conversation ids is sequential by nature:
ids stream through one task per node, which holds a batch of them at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.running import with_starts
from riskweave.llm.tables import WORD, numbers, run_starts, whole_runs
from riskweave.session import cut_lineage

# Turns that a container may hold before it is burst.
CONTAINER_ROWS = 4_096
# Copies of a row that are spelled out by one array.
COPIES = 65_536
LIMBS = ["limb_0", "limb_1", "limb_2", "limb_3"]
HEAD = ["depth", "head_0", "head_1"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
VALUES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def positions(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, words): the turns of every conversation, numbered from 1."""
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # equal rows are counted first, so that very many of them are one row of the order
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    placed = with_starts(counted, ["conv_id"], ["turn", "role", "text"], ["n"])
    stretches = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}")))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("n") - F.col("stretch") * COPIES, F.lit(COPIES))))
    return (
        placed.select("conv_id", "before_n", "n", F.xxhash64("role", "text").alias("turn_id"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
        .withColumn("stretch", stretches)
        .withColumn("copy", each)
        .select("conv_id", (F.col("before_n") + F.col("stretch") * COPIES + F.col("copy")).alias("place"), "turn_id", "words")
    )


def with_shared_heads(placed: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the turns of their family's first one, as branches of one exchange do.

    Conversation c takes the first h = crc32(c) % ``most`` turns of conversation c - c % ``family`` in place of its own first h.
    Returns (conv_id, total) and the paths (conv_id, depth, turn_id, words, total). ``placed`` is a written table.
    """
    own = placed.groupBy("conv_id").agg(F.max("place").alias("length"))
    first = placed.filter(F.col("place") < most).groupBy(F.col("conv_id").alias("base"))
    first = first.agg(F.sort_array(F.collect_list(F.struct("place", "turn_id", "words"))).alias("first"))
    taken = F.filter(F.coalesce("first", F.expr("array()")), lambda x: x["place"] <= F.col("h"))
    plan = cut_lineage(
        own.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
        .join(first, "base", "left")
        .withColumn("taken", taken)
        .select("conv_id", "h", "taken", (F.size("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).cast("long").alias("total"))
    )
    head = plan.select("conv_id", "total", F.explode("taken").alias("t")).select("conv_id", F.col("t.place").alias("depth"), "t.turn_id", "t.words", "total")
    keys = plan.select("conv_id", "h", "total", F.size("taken").alias("m"))
    rest = placed.join(keys, "conv_id").filter(F.col("place") > F.col("h"))
    rest = rest.select("conv_id", (F.col("m") + F.col("place") - F.col("h")).alias("depth"), "turn_id", "words", "total")
    return plan.select("conv_id", "total"), head.union(rest)


def _head(depth: Column, sums: list[Column]) -> list[Column]:
    return [F.xxhash64(depth, *sums), F.xxhash64(*reversed(sums), depth + 1)]


def with_heads(paths: DataFrame) -> DataFrame:
    """Add the head that ends with each row's turn (head_0, head_1) and the one before it (up_0, up_1)."""
    depth = F.col("depth").cast("long")
    two = [F.xxhash64(depth, "turn_id"), F.xxhash64("turn_id", depth, F.lit(5))]
    # limbs of 32 bits, whose sums stay within a long
    parts = [p for h in two for p in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    cut = paths.select("conv_id", depth.alias("depth"), "words", "total", *[p.alias(c) for p, c in zip(parts, LIMBS, strict=True)])
    summed = with_starts(cut, ["conv_id"], ["depth"], LIMBS)
    before = [F.col(f"before_{c}") for c in LIMBS]
    here, up = _head(F.col("depth"), [b + F.col(c) for b, c in zip(before, LIMBS, strict=True)]), _head(F.col("depth") - 1, before)
    return summed.select(
        "conv_id", "depth", "words", "total", here[0].alias("head_0"), here[1].alias("head_1"), up[0].alias("up_0"), up[1].alias("up_1")
    )


def burst(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The rows of burst heads, and the rows left in containers with their container (top, box_0, box_1, over_0, over_1).

    ``rows`` is a written table. The turns under a head are those of its members from the head's own turn on.
    """
    below = rows.groupBy(*HEAD).agg(F.sum(F.col("total") - F.col("depth") + 1).alias("held")).filter(F.col("held") > limit)
    marked = cut_lineage(rows.join(below.select(*HEAD, F.lit(True).alias("burst")), HEAD, "left").withColumn("burst", F.col("burst").isNotNull()))
    box = F.struct("depth", "head_0", "head_1", "up_0", "up_1")
    per = marked.filter("not burst").groupBy("conv_id").agg(F.min(box).alias("box"))
    per = per.select(
        "conv_id", F.col("box.depth").alias("top"), F.col("box.head_0").alias("box_0"), F.col("box.head_1").alias("box_1"),
        F.col("box.up_0").alias("over_0"), F.col("box.up_1").alias("over_1"),
    )
    return marked.filter("burst").drop("burst"), marked.filter("not burst").join(per, "conv_id").drop("burst", "up_0", "up_1")


def sweep(paths: list[tuple[tuple, int, tuple]], depth: int) -> list[list]:
    """The nodes of a container's paths (turns from the head's own on, conv_id, words): ``VALUES`` of each, the head's last.

    ``depth`` is the head's; the parent of the head itself is left open.
    """
    out: list[list] = []
    stack: list[dict] = []
    before: tuple = ()
    for turns, conv, words in [*sorted(paths), ((), 0, ())]:
        common = sum(1 for _ in takewhile(lambda x: x[0] == x[1], zip(before, turns, strict=False)))
        while len(stack) > common:
            node = stack.pop()
            n = len(node["ends"]) + node["n"]
            low = min([*node["ends"][:1], *node["lows"]])
            saved, leaves = node["saved"] + (n - 1) * node["words"], node["leaves"] or 1
            for child in node["children"]:
                out[child][2] = low
            ends = hashlib.sha256(",".join(map(str, node["ends"])).encode()).hexdigest()
            if stack:
                up = stack[-1]
                up["n"] += n
                up["saved"] += saved
                up["leaves"] += leaves
                up["lows"].append(low)
                up["children"].append(len(out))
            out.append([low, depth + len(stack), None, n, len(node["children"]), leaves, saved, ends])
        for w in words[common:]:
            stack.append({"words": w, "ends": [], "n": 0, "saved": 0, "leaves": 0, "lows": [], "children": []})
        if turns:
            stack[-1]["ends"].append(conv)
        before = turns
    return out


def container_nodes(rows: DataFrame) -> DataFrame:
    """``VALUES`` of the nodes of all containers; a head's own node has ``over_0``, ``over_1``, the head above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, ["box_0", "box_1", "top"]):
            c = {name: numbers(t[name]) for name in t.column_names}
            box = [c["box_0"], c["box_1"], c["top"]]
            boxes, paths = run_starts(box), np.append(run_starts([*box, c["conv_id"]]), t.num_rows)
            first = np.append(np.searchsorted(paths, boxes), len(paths) - 1)
            turns, words = list(zip(c["head_0"].tolist(), c["head_1"].tolist(), strict=True)), c["words"].tolist()
            rows: list[list] = []
            for i, at in enumerate(boxes):
                spans = [(paths[j], paths[j + 1]) for j in range(first[i], first[i + 1])]
                found = sweep([(tuple(turns[a:b]), int(c["conv_id"][a]), tuple(words[a:b])) for a, b in spans], int(c["top"][at]))
                rows += [[*r, None, None] for r in found[:-1]]
                rows.append([*found[-1], int(c["over_0"][at]), int(c["over_1"][at])])
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 7 + [pa.string()] + [pa.int64()] * 2
            yield pa.record_batch([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=[*VALUES, "over_0", "over_1"])

    schema = ", ".join(f"{v} {'string' if v == 'ends_sha256' else 'long'}" for v in VALUES) + ", over_0 long, over_1 long"
    order = ["box_0", "box_1", "top", "conv_id", "depth"]
    dealt = rows.select(*order, "head_0", "head_1", "words", "over_0", "over_1").repartition("box_0", "box_1", "top").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, schema)


def _ends(rows: DataFrame) -> DataFrame:
    """(depth, head_0, head_1, ends_sha256): hash of the ids of the members that end at each head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        done: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = [numbers(batch.column(i)) for i in range(3)], numbers(batch.column(3))
            starts = run_starts(keys)
            for low, high in zip(starts, np.append(starts[1:], len(ids)), strict=True):
                key = tuple(int(k[low]) for k in keys)
                text = ",".join(map(str, ids[low:high].tolist())).encode()
                if key == held:
                    digest.update(b"," + text)
                    continue
                if held is not None:
                    done.append((*held, digest.hexdigest()))
                held, digest = key, hashlib.sha256(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=[*HEAD, "ends_sha256"])
                done = []
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*held, digest.hexdigest())], names=[*HEAD, "ends_sha256"])

    ended = rows.filter(F.col("depth") == F.col("total")).select(*HEAD, "conv_id")
    return ended.repartition(*HEAD).sortWithinPartitions(*HEAD, "conv_id").mapInArrow(run, "depth long, head_0 long, head_1 long, ends_sha256 string")


def trie(conversations: DataFrame, paths: DataFrame, limit: int = CONTAINER_ROWS) -> DataFrame:
    """``VALUES`` of every node of the trie of ``conversations`` (conv_id, total) along ``paths`` (conv_id, depth, turn_id, words, total)."""
    heads, contained = burst(cut_lineage(with_heads(paths)), limit)
    inside = cut_lineage(container_nodes(contained))
    tops = inside.filter("over_0 is not null")

    zero = F.lit(0).cast("long")
    at_root = _head(zero, [zero] * 4)
    root = conversations.select("conv_id", zero.alias("depth"), zero.alias("words"), "total", at_root[0].alias("head_0"), at_root[1].alias("head_1"))
    above = cut_lineage(heads.unionByName(root, allowMissingColumns=True))
    nodes = above.groupBy(*HEAD).agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.max("up_0").alias("up_0"), F.max("up_1").alias("up_1")
    )
    nodes = cut_lineage(nodes)
    parents = nodes.filter("depth > 0").select(F.col("depth") - 1, "up_0", "up_1").union(tops.select(F.col("depth") - 1, "over_0", "over_1"))
    children = parents.toDF(*HEAD).groupBy(*HEAD).agg(F.count("*").alias("n_children"))
    nodes = cut_lineage(nodes.join(children, HEAD, "left").withColumn("n_children", F.coalesce("n_children", zero)))

    # what each node and container adds to the subtrees it is part of, on the path of one member
    credit = nodes.select(
        F.col("node").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves")
    )
    beyond = tops.groupBy("conv_id").agg(F.sum("saved_tokens").alias("saved_below"), F.sum("n_leaves").alias("leaves_below"))
    values = above.join(credit, ["conv_id", "depth"], "left").select(
        *HEAD, "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("saved", "leaves")]
    )
    summed = with_starts(values, ["conv_id"], ["depth"], ["saved", "leaves"])
    whole = values.groupBy("conv_id").agg(F.sum("saved").alias("all_saved"), F.sum("leaves").alias("all_leaves")).join(beyond, "conv_id", "left")
    subtree = summed.join(cut_lineage(whole), "conv_id").groupBy(*HEAD).agg(
        *[
            F.sum(F.col(f"all_{c}") + F.coalesce(f"{c}_below", zero) - F.col(f"before_{c}")).alias(name)
            for c, name in (("leaves", "n_leaves"), ("saved", "saved_tokens"))
        ]
    )
    known = nodes.select((F.col("depth") + 1).alias("depth"), F.col("head_0").alias("up_0"), F.col("head_1").alias("up_1"), F.col("node").alias("parent_conv_id"))
    up = ["depth", "up_0", "up_1"]
    upper = (
        nodes.join(cut_lineage(subtree), HEAD)
        .join(_ends(above), HEAD, "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
        .join(known, up, "left")
        .withColumnRenamed("node", "conv_id")
    )
    placed = tops.drop("parent_conv_id").withColumnsRenamed({"over_0": "up_0", "over_1": "up_1"}).join(known, up)
    return upper.select(*VALUES).union(placed.select(*VALUES)).union(inside.filter("over_0 is null").select(*VALUES))
