"""Registered queries: equal to their SQL, or to a plain version, over a whole small table."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import is_held_out, words
from tokenizers import Tokenizer

import __spark_entry__ as contract
from riskweave.llm import queries
from tools.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("select * from documents order by doc_id").df()


def test_all_are_registered():
    names = contract.queries()
    assert {*queries.QUERIES, "pipeline"} <= set(names)
    assert [n for i in range(1, 14) for n in names if n.startswith(f"op{i}_")] == list(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.sql()))
def test_equals_sql(spark, duck, name):
    assert difference(queries.QUERIES[name](spark, FOLDER).toPandas(), duck.sql(queries.sql()[name]).df()) is None


def test_languages(spark, documents):
    found = queries.QUERIES["op1_language_crf"](spark, FOLDER).toPandas().set_index("doc_id")
    assert sorted(found.index) == sorted(documents.doc_id)
    truth = documents.set_index("doc_id").lang
    held = [i for i in truth.index if is_held_out(i)]
    assert list(found.held_out[held]) == [True] * len(held) and found.held_out.sum() == len(held)
    assert (found.lang_pred[held] == truth[held]).mean() >= 0.9


def test_shards(spark, documents):
    found = queries.QUERIES["op3_hilbert_shards"](spark, FOLDER).toPandas().set_index("doc_id")
    texts = documents.set_index("doc_id").text
    assert found["size"].to_dict() == {i: len(t.encode()) + 16 for i, t in texts.items()}
    assert found.text_crc32.to_dict() == {i: zlib.crc32(t.encode()) for i, t in texts.items()}
    assert set(found.law) == {"bytes"} and found.grown_shard.isna().all()
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_contaminated_documents_hold_their_item(spark, duck, documents):
    items = duck.sql("select * from benchmark").df()
    squash = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    plain = {
        (d, i)
        for d, t in zip(documents.doc_id, map(squash, documents.text), strict=True)
        for i, x in zip(items.item_id, map(squash, items.text), strict=True)
        if f" {x} " in f" {t} "
    }
    found = queries.QUERIES["op4_decontaminate"](spark, FOLDER).toPandas()
    got = set(zip(found.doc_id, found.item_id, strict=True))
    assert plain <= got
    assert len(got) <= 1.1 * len(plain) + 1


def test_token_places(spark, documents):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, start = [], 0
    for doc_id, text in zip(documents.doc_id, documents.text, strict=True):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = queries.QUERIES["op7_token_file"](spark, FOLDER).orderBy("doc_id")
    assert [tuple(r) for r in found.select("doc_id", "start", "n_tokens", "ids_crc32").collect()] == expected


def test_toxicity(spark, duck, documents):
    found = queries.QUERIES["op10_toxicity"](spark, FOLDER).toPandas()
    assert sorted(found.doc_id) == sorted(documents.doc_id)
    labels = duck.sql("select doc_id, toxic from labels").df()
    joined = found.merge(labels, on="doc_id")
    seen = joined[~joined.held_out]
    assert (seen.predicted == seen.toxic).mean() >= 0.85
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.5)).all()


def test_package_can_go(tmp_path):
    """Without the package and the pipeline, the entry module imports and has the other queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(contract.__file__))
    shutil.copytree(os.path.join(root, "riskweave"), tmp_path / "riskweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.stdout.split()[1:] == ["False", "False"], done.stderr


def test_words_rule():
    assert words("a b\x0bc\x1cd e") == ["a b", "c\x1cd", "e"]
