"""Every stage on planted rows, each held against a plain version on its own input."""

import random

import pytest
from llm_fixtures import frame, key, odd_rows, words

import corpus_pipeline
from riskweave.llm import mixing


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    root = tmp_path_factory.mktemp("tables")
    bench = [(i, " ".join(f"b{rng.randrange(500)}" for _ in range(20)) + f". answer is b{i} c{i} d{i}") for i in range(5)]
    rows, labels = [], []
    for i in range(240):
        text = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 120))]
        if i % 6 == 1:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["blarg", "snib"]))
        labels.append((i, int(i % 6 == 1)))
        if i % 24 == 3:
            text = rows[i - 3][1].split()  # a copy with one word changed
            text[rng.randrange(1, len(text) - 1)] = "changed"
        if i % 40 == 5:
            text[30:30] = bench[i // 40 % 5][1].split()
        rows.append((i, " ".join(text), ("en", "fr")[i % 2], f"s{i % 4}", 0))
    rows += [(1000 + (r[0] or 0), *r[1:]) for r in odd_rows()]
    frame(spark, rows, clashing=True).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(root / "labels.parquet"))
    return str(root)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()), key=key)


def test_order_and_columns():
    wanted = ["toxicity", "Jaccard", "decontamination", "mixing", "sharding"]
    assert [any(w in name for w in [wanted[i]]) for i, (name, _) in enumerate(corpus_pipeline.STAGES)] == [True] * 5


def test_toxic_documents_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = stage("toxicity")(spark, docs, folder)
    assert kept.columns == corpus_pipeline.COLUMNS
    ids = {r["doc_id"] for r in kept.collect()}
    toxic = {i for i in range(240) if i % 6 == 1 and i % 24 != 3}
    clean = {i for i in range(240)} - toxic
    assert len(ids & toxic) <= 0.05 * len(toxic)
    assert len(ids & clean) >= 0.97 * len(clean)


def test_one_of_each_group_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 60 or doc_id >= 1000")
    before = rows_of(docs)
    kept = stage("n-gram Jaccard join")(spark, docs, folder)
    after = rows_of(kept)
    assert kept.columns == corpus_pipeline.COLUMNS
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [words(t)] for i in range(len(w) - 4)} or ({tuple(words(t))} - {()})
    assert len(set(after)) == len(after) and set(after) <= set(before)

    def near(a, b):
        x, y = shingles(a[1]), shingles(b[1])
        return a == b or bool(x) and 100 * len(x & y) >= 80 * len(x | y)

    for i, row in enumerate(after):
        assert not any(near(row, other) for other in after[:i])
    for row in before:
        assert any(near(row, other) for other in after)


def test_benchmark_documents_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = stage("benchmark decontamination")(spark, docs, folder)
    gone = {r[0] for r in rows_of(docs)} - {r[0] for r in rows_of(kept)}
    assert gone == {i for i in range(240) if i % 40 == 5}
    assert len(rows_of(kept)) == docs.count() - len(gone)


def test_mix_takes_whole_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = stage("mixing sources to target weights")(spark, docs, folder)
    assert mixed.columns == corpus_pipeline.COLUMNS
    before, after = rows_of(docs), rows_of(mixed)
    assert set(after) <= set(before)
    assert {r for r in before if not words(r[1])} <= set(after)
    assert all(after.count(r) <= 3 * before.count(r) for r in set(after))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_mix_comes_near_its_targets_and_is_mixed(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 240")
    wanted = {r["source"]: r["target"] for r in mixing.targets(mixing.sizes(docs)).collect()}
    mixed = [(r["source"], len(words(r["text"]))) for r in stage("mixing sources to target weights")(spark, docs, folder).collect()]
    taken = {s: sum(n for source, n in mixed if source == s) for s in wanted}
    # only a stream's last document is rounded
    assert all(abs(taken[s] - target) <= max(n for source, n in mixed if source == s) for s, target in wanted.items())
    # slots hold blocks of thousands of words: every quarter of the rows has several sources
    quarter = len(mixed) // 4
    assert all(len({source for source, _ in mixed[i * quarter : (i + 1) * quarter]}) >= 2 for i in range(4))


def test_shards_have_equal_bytes(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 240")
    sharded = stage("sharding")(spark, docs, folder).collect()
    sizes = {}
    for r in sharded:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + len(r["text"].encode()) + 16
    largest = max(len(r["text"].encode()) + 16 for r in sharded)
    assert len(sizes) == 40
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_shards_hold_every_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sharded = stage("sharding")(spark, docs, folder)
    assert rows_of(sharded) == rows_of(docs)
    for s in {r["shard"] for r in sharded.collect()}:
        slots = sorted(r["slot"] for r in sharded.filter(f"shard = {s}").collect())
        assert slots == list(range(len(slots)))


def test_run_chains_the_stages(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == [*corpus_pipeline.COLUMNS, "shard", "slot"]
    ids = {r["doc_id"] for r in found.collect()}
    assert not ids & {i for i in range(240) if i % 40 == 5}
    assert ids <= {*range(240), *(1000 + (r[0] or 0) for r in odd_rows())}


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs, folder).count() == 0
