import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import weak_quality as wq

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    """Half of the labels are given as votes; the scorer is held against the other half."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = wq.train(docs, labels.filter(half))
    rows = wq.score_documents(docs, model).join(labels.filter(~half), "doc_id").collect()
    bad = np.array([r["quality"] == 0 or r["toxic"] == 1 for r in rows])
    kept = np.array([r["kept"] for r in rows])
    assert kept[~bad].mean() > 0.97 and (~kept)[bad].mean() > 0.75
    # The estimated labellers point the right way.
    chance = model.quality["chance"]
    assert chance[1, 0, wq.BAD] > chance[0, 0, wq.BAD] and chance[0, 7, wq.GOOD] > chance[1, 7, wq.GOOD]


def test_estimation_finds_labellers():
    """Votes made with known accuracies: the estimates come near them, without human votes."""
    rng = np.random.RandomState(1)
    truth = rng.rand(40_000) < 0.2
    right = [0.95, 0.85, 0.7, 0.9]
    columns = []
    for p in right:
        said = np.where(rng.rand(len(truth)) < p, truth, ~truth)
        columns.append(np.where(rng.rand(len(truth)) < 0.3, wq.NONE, np.where(said, wq.BAD, wq.GOOD)))
    rows = np.stack([*columns, np.zeros(len(truth), int)], 1)
    patterns, counts = np.unique(rows, axis=0, return_counts=True)
    found = wq.estimate(patterns, counts.astype(float), strength=0.001)
    assert abs(found["share"][1] - 0.2) < 0.03
    for k, p in enumerate(right):
        assert abs(found["chance"][1, k, wq.BAD] - 0.7 * p) < 0.06


def test_awkward(spark, awkward):
    docs = awkward.drop("kept")
    for labels in (None, spark.createDataFrame([(6, 1, 0), (6, 0, None), (7, None, 1)], "doc_id long, quality long, toxic long")):
        model = wq.train(docs, labels)
        rows = wq.score_documents(docs, model).collect()
        assert len(rows) == docs.count()
        assert not any(r["kept"] for r in rows if not (r["text"] or "").strip())
        assert len({(r["p_bad"], r["p_toxic"]) for r in rows if r["text"] == docs.filter("doc_id = 7").first()["text"]}) == 1
    empty = docs.filter("false")
    assert wq.drop_rejected(empty, wq.train(empty)).count() == 0
