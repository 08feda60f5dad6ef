"""Sparse vectors and their near-duplicates against brute force."""

import math
import random

import pytest

from corpusmill.operators import terms
from corpusmill.operators.similarity import deduplicate_by_embedding
from corpusmill.operators.terms import sparse_cosine_pairs, sparse_graph, term_vectors, terms_removed

DDL = "seq long, terms array<string>, weights array<float>"


def invented(seed, n=150):
    """Vectors in families of near copies at different distances, and some alone."""
    rng = random.Random(seed)
    rows, family = [], []
    for i in range(n):
        if not family or rng.random() < 0.25:
            family = [(f"t{rng.randrange(60)}", rng.random() + 0.05) for _ in range(rng.randrange(3, 12))]
        own = dict(family)
        for _ in range(rng.randrange(3)):
            own[f"t{rng.randrange(60)}"] = rng.random() * rng.choice([0.05, 0.2, 0.6])
        rows.append((i, sorted(own), [own[t] for t in sorted(own)]))
    return rows


def cosine(a, b):
    x, y = dict(zip(a[1], a[2])), dict(zip(b[1], b[2]))
    return sum(v * y.get(t, 0) for t, v in x.items()) / math.sqrt(sum(v * v for v in a[2]) * sum(v * v for v in b[2]))


def first_come(rows, threshold):
    kept, gone = [], set()
    for row in rows:
        if any(cosine(row, other) >= threshold for other in kept):
            gone.add(row[0])
        else:
            kept.append(row)
    return gone


@pytest.mark.parametrize("threshold", [0.95, 0.7, 0.3])
def test_pairs_equal_brute_force(spark, threshold):
    rows = invented(1)
    got = {(r["lo"], r["hi"]): r["cosine"] for r in sparse_cosine_pairs(spark.createDataFrame(rows, DDL), threshold).collect()}
    want = {(a[0], b[0]): c for i, a in enumerate(rows) for b in rows[i + 1 :] if (c := cosine(a, b)) >= threshold}
    assert set(got) == set(want) and len(want) > 20
    assert all(got[p] == pytest.approx(want[p], abs=1e-5) for p in want)


def test_cliques_and_pairs_hold_every_link(spark):
    rows = invented(2)
    pairs, cliques = sparse_graph(spark.createDataFrame(rows, DDL), 0.9)
    groups = {}
    for r in cliques.collect():
        groups.setdefault(r["clique"], []).append(r["seq"])
    inside = {(min(a, b), max(a, b)) for g in groups.values() for a in g for b in g if a != b}
    listed = {(r["lo"], r["hi"]) for r in pairs.collect()}
    want = {(a[0], b[0]) for i, a in enumerate(rows) for b in rows[i + 1 :] if cosine(a, b) >= 0.9}
    assert inside | listed == want and inside and not inside & listed


@pytest.mark.parametrize("seed, threshold", [(3, 0.95), (4, 0.8)])
def test_first_come(spark, seed, threshold):
    rows = invented(seed)
    got = {r["seq"] for r in terms_removed(spark.createDataFrame(rows, DDL), threshold).collect()}
    assert got == first_come(rows, threshold) and got


def test_a_large_group_of_near_copies_makes_no_pairs(spark):
    rng = random.Random(5)
    base = {f"w{k}": 1.0 for k in range(40)}
    rows = []
    for i in range(600):
        own = base | {f"x{i}": 0.2 + 0.1 * rng.random()}
        rows.append((i, sorted(own), [own[t] for t in sorted(own)]))
    pairs, cliques = sparse_graph(spark.createDataFrame(rows, DDL), 0.95)
    assert pairs.count() == 0 and cliques.count() == 600
    assert terms_removed(spark.createDataFrame(rows, DDL)).count() == 599


def test_odd_vectors(spark):
    rows = [(0, ["a"], [1.0]), (1, ["a"], [2.0]), (2, [], []), (3, ["a", "b"], [0.0, 0.0]), (4, ["a"], [math.nan]), (5, None, None), (6, ["a"], [math.inf]), (7, ["a"], [None]), (8, ["b", "a"], [0.0, 1.0])]
    df = spark.createDataFrame(rows, DDL)
    assert {r["seq"] for r in terms_removed(df).collect()} == {1, 8}
    assert terms_removed(df.limit(0)).collect() == []


def test_texts_without_a_near_copy_survive(spark):
    rng = random.Random(6)
    words = [f"word{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(60)]
    texts[30] = texts[7] + " more"
    docs = spark.createDataFrame(list(enumerate(texts)), "seq long, content string")
    records = docs.join(term_vectors(docs).withColumnsRenamed({"terms": "content_embedding_terms", "weights": "content_embedding"}), "seq")
    kept, removed = deduplicate_by_embedding(records)
    assert [r["seq"] for r in removed.collect()] == [30] and kept.count() == 59


def test_pairs_out_of_reach_are_not_compared(spark, monkeypatch):
    """Sixty vectors list the same term; what follows it cannot bring any two of them to 0.9."""
    common = [(f"c{i}", math.sqrt(0.76 / 5)) for i in range(5)]
    rows = [(i, [f"u{i}", "s", *(t for t, _ in common)], [math.sqrt(0.12), math.sqrt(0.12), *(w for _, w in common)]) for i in range(60)]
    rows += [(100 + i, [t for t, _ in common] + [f"v{i}"], [w for _, w in common] + [0.9]) for i in range(5)]
    compared = []
    measured = terms._measured

    def counted(pairs, *others):
        compared.append(pairs.count())
        return measured(pairs, *others)

    monkeypatch.setattr(terms, "_measured", counted)
    vectors = spark.createDataFrame(rows, "seq bigint, terms array<string>, weights array<double>")
    assert sparse_cosine_pairs(vectors, 0.9).count() == 0
    assert sum(compared) < 60


def test_equal_vectors_are_folded_and_written_out(spark):
    rows = [(i, ["a", "b"], [1.0, 1.0]) for i in range(6)] + [(9, ["a", "b"], [1.0, 1.1])]
    found = sparse_cosine_pairs(spark.createDataFrame(rows, "seq bigint, terms array<string>, weights array<double>"), 0.9).collect()
    assert {(r["lo"], r["hi"]) for r in found} == {(i, j) for i in range(6) for j in (*range(i + 1, 6), 9)}
    assert len(found) == 21


def test_vectors_that_name_a_term_twice_are_all_compared(spark):
    """Such vectors come from repeated keys; no bound may drop their pairs, and the order of a pair counts."""
    rows = [(1, ["a", "a", "b", "b"], [1.0, 1.0, 1.0, 1.0]), (0, ["a", "b"], [1.0, 1.0]), (2, ["a", "b"], [1.0, 1.0]), (3, ["a", "b", "c"], [1.0, 1.0, 0.8])]
    found = sparse_cosine_pairs(spark.createDataFrame(rows, "seq bigint, terms array<string>, weights array<double>"), 0.9).collect()
    got = {(r["lo"], r["hi"]): round(r["cosine"], 4) for r in found}
    assert got == {(0, 1): 1.4142, (0, 2): 1.0} and len(found) == 2
