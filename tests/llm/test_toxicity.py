"""Toxicity: the label model against direct computation and known truths, the classifier on held-out rows, odd input."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import toxicity
from corpusmill.llm.toxicity import CLEAN, FIXED, NO_VOTE, TOXIC, VOTERS, LabelModel, Texts, estimate, forest, pack, score_documents, train, unpack

NONE = [np.zeros(0, np.uint64)] * 2


def voted(*texts):
    t = Texts(pa.array(texts, pa.string()))
    return [{VOTERS[k] for k in np.flatnonzero(row)} for row in t.votes(NONE, np.zeros(t.n, np.int64))]


def test_voters():
    calm = "one two three four five six seven eight nine ten"
    got = voted(calm, calm + " idiot", "You are such an IDIOT", "trash and scum", "idiot you said nobody", "WHAT!! A!! DAY!!", None, "", "Je te tuer")
    assert got == [
        {"calm"}, {"mind"}, {"mind"}, {"filth", "several"}, {"mind", "worth", "several", "addressed"}, {"shouting"}, set(), set(), {"threat"},
    ]
    assert "addressed" in voted("you total idiot")[0] and "addressed" not in voted("idiot, you there")[0]


def test_words_and_beginnings_keep_characters_whole():
    t = Texts(pa.array(["Éclair éclairs", "ab abc"]))
    for word, size in (("écl", 3), ("éclair", 6)):
        term = toxicity.mix(toxicity.hash_spans(np.frombuffer(word.encode(), np.uint8), np.array([0]), np.array([len(word.encode())]), fold=False) + np.uint64(size))
        assert list(t.having(term)) == [2, 0]


def test_score_is_the_product_of_features_and_weights():
    t = Texts(pa.array(["alpha beta beta gamma", None, "", "alpha you idiot moron " * 3]))
    votes = t.votes(NONE, np.zeros(4, np.int64))
    weights = np.random.RandomState(2).randn(1 << toxicity.BITS) * 0.3
    row, bucket, value = t.features(votes[:, :FIXED])
    dense = np.bincount(row, weights[bucket] * value, minlength=4) + 0.1
    assert np.allclose(t.score(weights, 0.1, votes[:, :FIXED].astype(float)), 1 / (1 + np.exp(-dense)))


def test_patterns_round_trip():
    votes = np.random.RandomState(1).randint(0, 2, (50, len(VOTERS)))
    assert np.array_equal(unpack(pack(votes)), votes)


def test_posterior_is_bayes_along_the_forest():
    rng = np.random.RandomState(3)
    n = len(VOTERS)
    parent = np.array([-1, 0, 0, 1] + [-1] * (n - 4))
    model = LabelModel(np.array([0.8, 0.2]), rng.uniform(0.1, 0.9, (2, n, 2)), parent, 0.9)
    for bits in itertools.islice(itertools.product((0, 1), repeat=n), 0, 1 << n, 97):
        votes = np.array([bits])
        for human, right in ((NO_VOTE, (1, 1)), (CLEAN, (0.9, 0.1)), (TOXIC, (0.1, 0.9))):
            joint = []
            for c in (0, 1):
                p = model.share[c] * right[c]
                for k in range(n):
                    x = model.chance[c, k, votes[0, parent[k]] if parent[k] >= 0 else 0]
                    p *= x if votes[0, k] else 1 - x
                joint.append(p)
            assert model.posterior(votes, np.array([human]))[0] == pytest.approx(joint[1] / sum(joint))


def invented_votes(n=20_000, seed=5):
    rng = np.random.RandomState(seed)
    truth = rng.rand(n) < 0.2
    votes = np.zeros((n, len(VOTERS)), np.int64)
    for k in range(len(VOTERS)):
        votes[:, k] = rng.rand(n) < np.where(truth, 0.4, 0.02)
    votes[:, 3] = np.where(rng.rand(n) < 0.95, votes[:, 2], votes[:, 3])  # a copy of its neighbour
    votes[:, -1] = rng.rand(n) < np.where(truth, 0.1, 0.9)
    return truth, votes


def test_accuracies_and_correlations_are_found_without_labels():
    truth, votes = invented_votes()
    pattern, n = np.unique(pack(votes), return_counts=True)
    model = estimate(unpack(pattern), np.zeros(len(pattern), np.int64), n.astype(float))
    assert {tuple(sorted(x)) for x in model.correlated()} == {tuple(sorted((VOTERS[2], VOTERS[3])))}
    assert model.share[1] == pytest.approx(0.2, abs=0.02)
    for name in (VOTERS[0], VOTERS[5]):
        clean, toxic = model.accuracies()[name]
        assert clean == pytest.approx(0.02, abs=0.01) and toxic == pytest.approx(0.4, abs=0.04)
    post = model.posterior(votes, np.zeros(len(votes), np.int64))
    assert ((post > 0.5) == truth).mean() > 0.96


def test_copied_voters_do_not_count_twice():
    truth, votes = invented_votes()
    pattern, n = np.unique(pack(votes), return_counts=True)
    model = estimate(unpack(pattern), np.zeros(len(pattern), np.int64), n.astype(float))
    alone = LabelModel(model.share, model.chance[:, :, :1].repeat(2, 2), np.full(len(VOTERS), -1), 0.98)
    row = np.zeros((1, len(VOTERS)), np.int64)
    row[0, [2, 3]] = 1
    assert model.posterior(row, np.zeros(1, np.int64))[0] < alone.posterior(row, np.zeros(1, np.int64))[0]


def test_forest_has_no_cycle():
    rng = np.random.RandomState(8)
    votes = rng.randint(0, 2, (200, 6))
    votes[:, 1] = votes[:, 0]
    votes[:, 4] = 1 - votes[:, 0]
    parent = forest(votes, np.column_stack([np.ones(200), np.ones(200)]), 0.05)
    assert (parent >= 0).sum() == 2
    for k in range(6):
        seen = set()
        while parent[k] >= 0:
            assert k not in seen
            seen.add(k)
            k = parent[k]


def _held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_rows(spark, run_query):
    """New words mark toxic rows, in a language without a list: they are learned from the labels and found in other rows."""
    rng = np.random.RandomState(6)
    stems = ["zorg", "quelp"]
    rows, labels = [], []
    for i in range(2000):
        words = ["".join(rng.choice(list("abdeimnorstu"), rng.randint(2, 8))) for _ in range(40)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randint(40), stems[rng.randint(2)] + "".join(rng.choice(list("aeiou"), 3)))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    given = spark.createDataFrame([x for x in labels if not _held_out(x[0])], "doc_id long, quality int, toxic int")
    model = train(docs, given, iterations=30)
    got = {r["doc_id"]: r for r in score_documents(docs, model).collect()}
    held = [x for x in labels if _held_out(x[0])]
    caught = [got[i]["predicted"] for i, _, t in held if t]
    wrong = [got[i]["predicted"] for i, _, t in held if not t]
    assert len(caught) > 20 and np.mean(caught) > 0.95 and np.mean(wrong) < 0.02
    assert "learned" in got[0]["voters"]


def test_query_covers_all_documents_and_learns_from_the_allowed_rows_only(spark, run_query, all_texts, tmp_path):
    got = run_query("op13_toxicity")
    assert set(got) == set(all_texts)
    assert all(r["held_out"] == _held_out(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    # Labels of held-out rows turned round: nothing changes.
    folder = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    turn = labels["doc_id"].map(_held_out)
    labels.loc[turn, "toxic"] = 1 - labels.loc[turn, "toxic"]
    spark.createDataFrame(labels).write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    again = run_query("op13_toxicity", sf=str(tmp_path))
    assert {i: r["predicted"] for i, r in again.items()} == {i: r["predicted"] for i, r in got.items()}


def test_odd_input(spark, awkward):
    docs = awkward.withColumn("score", awkward["n"]).withColumn("pattern", awkward["n"])
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, 1), (8, None), (None, 1), (10, 0), (99, 1)], "doc_id long, toxic int")
    got = score_documents(docs, train(docs, labels, iterations=5)).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert [f for f in got[0].asDict() if f not in docs.columns] == ["predicted", "voters"]
    unlabelled = score_documents(docs, train(docs, None, iterations=5)).collect()
    assert len(unlabelled) == docs.count()
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    nothing = docs.limit(0)
    assert score_documents(nothing, train(nothing, labels, iterations=5)).collect() == []
    assert len(score_documents(docs, train(docs, labels.limit(0), iterations=5)).collect()) == docs.count()
