"""Responses and rejects of the request stream as two tables, each row once."""

import glob
import os

from conftest import SMALL_DIR
from pyspark.sql import functions as F

from riskweave.plans.catalog import Scorecard
from riskweave.sources.events import requests_from_events
from riskweave.streaming import scoring as s


def test_each_request_is_in_one_table_once_after_a_forced_replay(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL_DIR}/events.parquet")
    inbox, responses, rejects, progress = (str(tmp_path / n) for n in ("in", "good", "bad", "progress"))
    events.filter("event_id % 2 = 0").write.parquet(inbox)

    def run():
        arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        s.start_scoring_apart(requests_from_events(arriving), Scorecard(), responses, rejects, progress, available_now=True, tasks=3).awaitTermination()

    run()
    events.filter("event_id % 2 = 1").write.mode("append").parquet(inbox)
    run()
    before = [s.read_answers(spark, f).toPandas() for f in (responses, rejects)]
    # the checkpoint forgets that its last batch ended, as after a failure between writing and committing
    last = max(glob.glob(f"{progress}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    run()
    good, bad = (s.read_answers(spark, f) for f in (responses, rejects))
    assert [good.count(), bad.count()] == [len(f) for f in before]
    whole = s.score_requests(requests_from_events(events), Scorecard())
    valid = whole.filter(F.size("errors") == 0).drop("errors")
    assert good.select(valid.columns).exceptAll(valid).count() == valid.exceptAll(good.select(valid.columns)).count() == 0
    wrong = whole.filter(F.size("errors") > 0).select("request_id", "errors")
    assert bad.exceptAll(wrong).count() == wrong.exceptAll(bad).count() == 0
    assert good.select("request_id").intersect(bad.select("request_id")).count() == 0


def test_a_batch_without_rejects_is_read(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL_DIR}/events.parquet")
    inbox, responses, rejects, progress = (str(tmp_path / n) for n in ("in", "good", "bad", "progress"))
    valid = s.score_requests(requests_from_events(events), Scorecard()).filter(F.size("errors") == 0)
    first = requests_from_events(events).join(valid.select("request_id").limit(1), "request_id")
    first.write.parquet(inbox)
    arriving = spark.readStream.schema(first.schema).parquet(inbox)
    s.start_scoring_apart(arriving, Scorecard(), responses, rejects, progress, available_now=True).awaitTermination()
    assert s.read_answers(spark, responses).count() == 1
    assert s.read_answers(spark, rejects).count() == 0
