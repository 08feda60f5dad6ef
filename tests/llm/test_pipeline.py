"""Each stage against a brute-force version on the rows it gets."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from corpusmill.llm import secret_scan, weak_quality
from corpusmill.session import materialize
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_sketch_join import brute as components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), "stage"))
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_columns(stages):
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns
    assert {"doc_id", "ids", "n_tokens"} <= set(stages[-1].columns)


def test_quality_stage(spark, stages):
    model = weak_quality.train(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r["doc_id"] for r in weak_quality.score_documents(stages[0], model).filter("kept").collect()}
    assert set(texts(stages[1])) == want and 0 < len(want) < stages[0].count()


def test_duplicate_stage(stages):
    want = {c for _, _, c in components(sorted(texts(stages[1]).items()))}
    assert set(texts(stages[2])) == want


def test_decontamination_stage(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(stages[2]), texts(stages[3])
    for key, text in before.items():
        n, hit, _ = contamination(text, items)
        assert (key in after) == (not (hit > 0 and 20 * hit >= n))
        if key in after and not hit:
            assert after[key] == text


def test_secret_stage(stages):
    scan = secret_scan.SecretScanner().scan
    before, after = texts(stages[3]), texts(stages[4])
    assert after == {k: secret_scan.redact(t, scan(t)) if scan(t) else t for k, t in before.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_bpe_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = texts(stages[4])
    for r in stages[5].collect():
        assert r["ids"] == library.encode(want[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"])
