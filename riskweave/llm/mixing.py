"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Sources in code point order, null last, weigh 1, 2, 3, repeating. A source's target is its weight's share of all words,
at most ``MOST`` times its own words; what is over is shared again by weight, which is one water level over all sources.

Every source's documents, in the order of a hash, make one stream of words that begins again at its end. The stream is cut
into blocks of ``BLOCK`` words; the source's quota is its rounded target. Slot i of the schedule takes the point
``frac(i * golden ratio)``, mapped through the cumulated quotas, so each stretch of the schedule is mixed as the whole.
The n-th slot of a source takes its n-th block, the last one only up to the quota. Slots beyond the quota are void; blocks
that the points did not reach (a few of each source, the discrepancy of the points) come at the end, so every source
gives exactly its quota.

Null texts have no words. Documents without words take part in no block (taken 0). Repeated rows are documents of their
own. With no words at all every target is 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm.running import with_starts
from riskweave.llm.tables import WORD
from riskweave.session import cut_lineage

MOST = 3
BLOCK = 4096
BINS = 1024
GOLDEN = 0.6180339887498949


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, place): place is the document's rank key in its source's shuffled order."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select("doc_id", "source", size.alias("size"), place.alias("place"), F.lit(1).cast("long").alias("one"))


def targets(sized: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target, quota, low): one row per source; ``low`` is where its quota begins."""
    every = W.partitionBy(F.lit(0))  # one row per source, not per document
    named = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("weight", (1 + (F.row_number().over(named) - 1) % 3).cast("long")).withColumn("cap", most * F.col("source_size"))
    per = per.withColumn("total", F.sum("source_size").over(every))
    # sources by how soon they are full: the level rises up to the first that stays open, and falls from there on
    filling = W.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - full) / open_weight)
    per = per.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(every))
    per = per.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0))))
    per = per.withColumn("quota", F.round("target").cast("long"))
    low = F.coalesce(F.sum("quota").over(named.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return per.select("source", "source_size", "weight", "target", "quota", low.alias("low"), F.sum("quota").over(every).alias("all_quota"))


def schedule(per_source: DataFrame, block: int = BLOCK, ratio: float = GOLDEN) -> DataFrame:
    """(slot, source, rank, first, last): slot takes words [first, last) of its source's stream."""
    spark = per_source.sparkSession
    total = per_source.agg(F.max("all_quota")).first()[0] or 0
    slots = -(-total // block)
    point = F.col("slot") * F.lit(ratio)
    points = spark.range(0, slots).withColumnRenamed("id", "slot")
    points = points.withColumn("x", F.floor((point - F.floor(point)) * F.lit(float(total))).cast("long"))
    points = points.withColumn("bin", F.floor(F.col("x") * BINS / F.lit(float(max(total, 1)))).cast("int"))
    bin_of = lambda x: F.floor(x * BINS / F.col("all_quota").cast("double")).cast("int")
    high = F.col("low") + F.col("quota")
    spread = per_source.filter("quota > 0").withColumn("bin", F.explode(F.sequence(bin_of(F.col("low")), bin_of(high))))
    drawn = points.join(spread, "bin").filter((F.col("x") >= F.col("low")) & (F.col("x") < high))
    ranked = with_starts(drawn.select("slot", "source", "quota", F.lit(1).cast("long").alias("one")), ["source"], ["slot"], ["one"])
    blocks = F.ceil(F.col("quota") / block).cast("long")
    kept = ranked.select("slot", "source", F.col("before_one").alias("rank"), "quota").filter(F.col("rank") < blocks)
    reached = kept.groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "reached_source")
    rest = (
        per_source.filter("quota > 0")
        .join(reached, F.col("source").eqNullSafe(F.col("reached_source")), "left")
        .filter(F.coalesce("n", F.lit(0)) < blocks)
        .select("source", "quota", F.explode(F.sequence(F.coalesce("n", F.lit(0)).cast("long"), blocks - 1)).alias("rank"))
        .select((F.lit(slots) + F.col("rank")).alias("slot"), "source", "rank", "quota")
    )
    first = F.col("rank") * block
    return kept.unionByName(rest).select(
        "slot", "source", "rank", first.alias("first"), F.least(first + block, F.col("quota")).alias("last")
    )


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every document with its place in its source's stream (begin, row) and what is known of the source; the sources."""
    sized = cut_lineage(sizes(docs))
    per_source = cut_lineage(targets(sized))
    placed = with_starts(sized, ["source"], ["place", "size"], ["size", "one"])
    known = per_source.withColumnRenamed("source", "of_source")
    placed = placed.join(known, F.col("source").eqNullSafe(F.col("of_source")))
    return cut_lineage(
        placed.select("doc_id", "source", "size", "source_size", "target", "quota", F.col("before_size").alias("begin"), F.col("before_one").alias("row"))
    ), per_source


def _sequence(placed: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    # a document stands once in every round of its source's stream that the quota reaches
    rounds = F.ceil(F.col("quota") / F.greatest("source_size", F.lit(1))).cast("int")
    copies = placed.filter("size > 0 and quota > 0").withColumn("round", F.explode(F.sequence(F.lit(0), rounds - 1)))
    copies = copies.withColumn("begin", F.col("begin") + F.col("round") * F.col("source_size"))
    end = F.col("begin") + F.col("size")
    ranks = F.sequence(F.floor(F.col("begin") / block).cast("long"), F.floor((end - 1) / block).cast("long"))
    pieces = copies.withColumn("rank", F.explode(ranks))
    drawn = slots.select("slot", F.col("source").alias("slot_source"), F.col("rank").alias("slot_rank"), "first", "last")
    joined = pieces.join(drawn, F.col("source").eqNullSafe(F.col("slot_source")) & (F.col("rank") == F.col("slot_rank")))
    low, high = F.greatest(F.col("begin"), F.col("first")), F.least(end, F.col("last"))
    return joined.filter(low < high).select(
        "slot", (low - F.col("first")).alias("offset"), "source", "row", "doc_id", "round",
        (low - F.col("begin")).alias("first_word"), (high - F.col("begin")).alias("last_word"),
    )


def sequence(docs: DataFrame, block: int = BLOCK, ratio: float = GOLDEN) -> DataFrame:
    """The mix itself: (slot, offset, source, row, doc_id, round, first_word, last_word), in order of (slot, offset).

    Each row stands for words [first_word, last_word) of a document, the ``row``-th of its source's stream, in its
    ``round``-th repetition. A slot holds one block of one source.
    """
    placed, per_source = _placed(docs)
    return _sequence(placed, cut_lineage(schedule(per_source, block, ratio)), block)


def mix(docs: DataFrame, block: int = BLOCK, ratio: float = GOLDEN) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, slots) of every document, out of the mixed sequence.

    ``slots`` has the slot with which each repetition of the document begins, in ascending order.
    """
    placed, per_source = _placed(docs)
    mixed = _sequence(placed, cut_lineage(schedule(per_source, block, ratio)), block)
    each = mixed.groupBy("source", "row", "round").agg(F.sum(F.col("last_word") - F.col("first_word")).alias("words"), F.min("slot").alias("slot"))
    taken = each.groupBy(F.col("source").alias("of_source"), F.col("row").alias("of_row")).agg(
        F.sum("words").alias("taken"), F.sort_array(F.collect_list("slot")).alias("slots")
    )
    joined = placed.join(taken, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("row") == F.col("of_row")), "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source", F.coalesce("slots", F.array().cast("array<long>")).alias("slots"))
