"""The bounded training sample: ids that are null or stand for many texts, large strata, long texts."""

import pytest
from llm_fixtures import frame, odd_rows
from pyspark.sql import functions as F

from riskweave.llm import language_crf, toxicity
from riskweave.llm.tables import sample_texts


def keys(docs):
    return docs.select("doc_id", "lang", F.xxhash64("text").alias("text_hash"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).distinct()


def test_one_id_with_very_many_texts(spark):
    docs = spark.range(20_000).selectExpr("if(id < 15000, 7L, id) as doc_id", "concat('text ', id) as text", "if(id % 2 = 0, 'en', 'de') as lang")
    found = sample_texts(docs, keys(docs), ["lang"], 50, 1000)
    assert len(found) == 100 and len(set(found)) == 100
    assert found == sample_texts(docs.repartition(3), keys(docs), ["lang"], 50, 1000)


def test_only_the_front_of_a_large_stratum_is_ranked(spark):
    docs = spark.range(50_000).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang")
    known = keys(docs).withColumn("place", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(10)), F.lit(1 << 40)))
    first = {r.text_hash for r in known.orderBy("place").limit(30).collect()}
    found = sample_texts(docs, keys(docs), ["lang"], 30, 1000)
    hashes = spark.createDataFrame([(t,) for t, _ in found], "text string").select(F.xxhash64("text").alias("h"))
    assert {r.h for r in hashes.collect()} == first


def test_bytes_are_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * 1000 + str(i), "en") for i in range(50)], "doc_id long, text string, lang string")
    assert len(sample_texts(docs, keys(docs), ["lang"], 40, 1000, most_bytes=10_100)) == 10


def test_null_ids_and_null_strata(spark):
    docs = spark.createDataFrame([(None, "a b", "en"), (1, "c d", None), (2, None, "en"), (3, "e f", "en")], "doc_id long, text string, lang string")
    assert {t for t, _ in sample_texts(docs, keys(docs), ["lang"], 10, 100)} == {"c d", "e f", None}


@pytest.mark.parametrize("ids", [1, 16])
def test_identify_takes_odd_rows(spark, ids):
    rows = [(r[0] if ids == 1 or r[0] is None else r[0] * ids, *r[1:]) for r in odd_rows()]
    found = language_crf.identify(frame(spark, rows, clashing=True)).collect()
    assert len(found) == len(rows)
    assert all(r.lang_pred == "und" for r in found if r.doc_id == 3 * ids)


def test_predict_takes_odd_rows(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(-3, 12)] + [(None, 1, 1), (1, 1, None), (2, 0, 1)], "doc_id long, quality int, toxic int")
    found = toxicity.predict(frame(spark, odd_rows(), clashing=True), labels).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
