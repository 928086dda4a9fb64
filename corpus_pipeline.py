"""A corpus from raw documents: toxic ones out, near copies out, benchmark text out, sources mixed, rows sharded.

Each stage takes (spark, docs, sf_dir) and returns documents; ``run`` writes each result as Parquet and reads it back as
the next stage's input, so a lost executor repeats work of one stage only. Rows are told apart by id *and* text, so
repeated rows and ids that stand for several texts pass through as separate documents. Null columns stay null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from riskweave.llm.tables import table
from riskweave.session import cut_lineage, new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Word shingles of the near-duplicate stage and the similarity, in hundredths, from which two documents are linked.
NEAR_WORDS, NEAR_HUNDREDTHS = 5, 80


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents; whatever else a table brings is dropped, so no name clashes with a stage's own."""
    return docs.select(*COLUMNS)


def _row_key() -> F.Column:
    """Tells rows apart that share an id; equal for rows that agree in all columns. The hash passes over nulls, so
    which columns are null is hashed too."""
    return F.xxhash64(*COLUMNS, *[F.col(c).isNull() for c in COLUMNS]).alias("row_key")


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents under a key in place of their id, for operators that return ids."""
    return docs.select(_row_key().alias("doc_id"), "text", "lang", "source", "n_chars")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier, trained on ``labels``, scores below one half."""
    docs = _documents(docs)
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, and one of rows that agree in every column."""
    keyed = _documents(docs).withColumn("row_key", _row_key())
    found = jaccard_join.jaccard_components(_numbered(docs), NEAR_WORDS, NEAR_HUNDREDTHS, 100)
    # without words a text is linked with nothing and heads its own component
    heads = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(heads, "row_key").dropDuplicates(["row_key"]).select(*COLUMNS)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no item of ``benchmark``."""
    keyed = _documents(docs).withColumn("row_key", _row_key())
    found = decontaminate.contaminated(_numbered(docs), table(spark, sf_dir, "benchmark"))
    bad = found.select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(bad, "row_key", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole time, in the order of the mix's slots.

    A copy stands where the document's repetition of that number begins; of rows that agree in everything, where the first
    of them does. Documents without words stay once, at the end.
    """
    keyed = _documents(docs).withColumn("row_key", _row_key())
    taken = mixing.mix(_numbered(docs)).groupBy(F.col("doc_id").alias("row_key")).agg(
        F.min("size").alias("size"),
        F.sum("taken").alias("taken"),
        F.count("*").alias("rows"),
        F.array(*[F.min(F.get("slots", F.lit(i))) for i in range(mixing.MOST)]).alias("slots"),
    )
    times = F.when(F.col("size") == 0, F.col("rows")).otherwise(F.round(F.col("taken") / F.col("size"))).cast("int")
    once = keyed.dropDuplicates(["row_key"]).join(taken.withColumn("times", times).filter("times > 0"), "row_key")
    each = once.withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
    return each.withColumn("slot", F.get("slots", (F.col("copy") - 1) % mixing.MOST)).orderBy(F.col("slot").asc_nulls_last()).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot; repeated rows get slots of their own."""
    keyed = _documents(docs).withColumn("row_key", _row_key())
    once = cut_lineage(keyed.dropDuplicates(["row_key"]))
    places = sharding.assign(_numbered(docs)).select(F.col("doc_id").alias("row_key"), "shard", "slot")
    return cut_lineage(places).join(once, "row_key").select(*COLUMNS, "shard", "slot")


STAGES = [
    ("toxicity", remove_toxic),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", remove_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]
# The first stage is a trained classifier: tests hold the pipeline against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
