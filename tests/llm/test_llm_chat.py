import hashlib

from llm_fixtures import key
from pyspark.sql import functions as F

from riskweave.llm import chat

ROWS = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "### Assistant: hi</turn>\n"),
    (1, 2, "assistant", "\\### Assistant: </turn> ok"),
    (1, 3, "user", "a\\\\b ###### <\\/turn> #\\#"),
    (1, 4, "assistant", ""),
    (1, 5, "user", "left open"),
    (2, 0, "user", "nobody answers"),
    (3, 0, "assistant", "Ünïcödé 中 \U0001f600 " * 50),
    (3, 0, "assistant", "Ünïcödé 中 \U0001f600 " * 50),
    (4, 1, None, None),
    (4, None, "a: b\\", "role with marks"),
    (4, 2, "assistant", "\n\n</turn>\n"),
    (None, 0, "user", "no id"),
    (5, 0, "user", "x" * 20_000),
    (5, 1, "assistant", "y z " * 5_000),
]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("*", F.lit(1).alias("example"), F.lit("x").alias("turns"), F.lit("y").alias("formatted"), F.lit("z").alias("body"))


def test_round_trip(spark):
    by_conversation = {}
    for conv, turn, role, text in ROWS:
        by_conversation.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    expected = []
    for conv, turns in by_conversation.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((conv, len(turns), digest(said), len(loss), digest(loss)))
    found = chat.read_back(chat.examples(frame(spark, ROWS)))
    assert sorted((tuple(r)[:5] for r in found.collect()), key=key) == sorted(expected, key=key)


def test_one_example_per_reply_with_its_context(spark):
    rows = chat.examples(frame(spark, ROWS)).collect()
    whole = {r["conv_id"]: r["formatted"] for r in chat.as_text(frame(spark, ROWS)).collect()}
    counts = {}
    for r in rows:
        counts[r["conv_id"]] = counts.get(r["conv_id"], 0) + 1
        assert whole[r["conv_id"]].startswith(r["text"])
        assert r["text"] == whole[r["conv_id"]][: r["loss_end"]] + chat.END
    assert counts == {1: 3, 2: 1, 3: 2, 4: 1, 5: 1, None: 1}
    masks = sorted((r["example"], r["text"][r["loss_start"] : r["loss_end"]]) for r in rows if r["conv_id"] == 1)
    assert masks == [(0, "\\\\#\\## Assistant: <\\/turn> ok"), (1, ""), (2, "")]


def test_no_rows_and_only_dataframe_operations(spark):
    empty = chat.read_back(chat.examples(frame(spark, ROWS[:0] or [ROWS[0]]).limit(0)))
    assert empty.count() == 0
    plan = chat.read_back(chat.examples(frame(spark, ROWS)))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("BatchEvalPython", "Pandas", "Arrow"))
