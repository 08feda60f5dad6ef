import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedup as D
from corpusmill.operators import similarity as S
from corpusmill.operators.resolver import removed_by_first_come


def greedy(n, close):
    removed = set()
    for i in range(n):
        if i in removed:
            continue
        removed |= {j for j in range(i + 1, n) if j not in removed and close(i, j)}
    return removed


def seqs(df):
    return {r["seq"] for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_resolver_random_graphs(spark, seed):
    rng = random.Random(seed)
    n = 40
    edges = {(i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < [0.02, 0.05, 0.15, 0.4][seed]}
    df = spark.createDataFrame([(a, b) for a, b in edges], "lo bigint, hi bigint")
    assert seqs(removed_by_first_come(df)) == greedy(n, lambda i, j: (i, j) in edges)


def test_resolver_chain_keeps_third(spark):
    df = spark.createDataFrame([(1, 2), (2, 3)], "lo bigint, hi bigint")
    assert seqs(removed_by_first_come(df)) == {2}


def test_resolver_empty(spark):
    assert seqs(removed_by_first_come(spark.createDataFrame([], "lo bigint, hi bigint"))) == set()


@pytest.mark.parametrize("seed", range(3))
def test_resolver_cliques(spark, seed):
    rng = random.Random(100 + seed)
    n = 30
    clique = {i: rng.randrange(6) for i in range(n) if rng.random() < 0.7}
    edges = {(i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.06 and clique.get(i, -1) != clique.get(j, -2)}
    close = lambda i, j: (i, j) in edges or (i in clique and clique.get(i) == clique.get(j))
    edge_df = spark.createDataFrame(list(edges), "lo bigint, hi bigint")
    clique_df = spark.createDataFrame([(c, i) for i, c in clique.items()], "clique bigint, seq bigint")
    assert seqs(removed_by_first_come(edge_df, clique_df)) == greedy(n, close)


def test_hash(spark):
    rows = [
        (0, "a", "t", "en", "same" * 20), (1, "a", "u", "fr", "same" * 30), (2, "", "t", "en", "x"), (3, None, "t", "en", "x"),
        (4, None, "t", "en", "y"), (5, "a", "t", "en", "other"), (6, None, "t", "en", None), (7, None, "t", "en", None),
    ]
    df = spark.createDataFrame(rows, "seq bigint, id string, title string, language string, content string")
    kept, removed = D.deduplicate_by_hash(df, prefix=50)
    assert seqs(kept) == {0, 2, 4, 5, 6} and seqs(removed) == {1, 3, 7}
    kept, removed = D.deduplicate_by_hash(df)
    assert seqs(kept) == {0, 1, 2, 4, 5, 6} and seqs(removed) == {3, 7}


def simhash(text):
    text = "".join(re.findall(r"[\w一-鿌]+", text.lower()))
    grams = [text[i : i + 4] for i in range(max(len(text) - 3, 1))]
    votes = [0] * 64
    for g in grams:
        h = int.from_bytes(hashlib.md5(g.encode()).digest()[-8:], "big")
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    value = sum(1 << b for b in range(64) if votes[b] > 0)
    return value - (1 << 64) if value >= 1 << 63 else value


def test_simhash_values_and_removal(spark):
    texts = [
        "Python is great for testing algorithms", "Python is great for testing algorithm", "Completely different text",
        "", "ab", "Ünïcode 中文字 text_1", "", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, content string")
    got = {r["seq"]: r["fingerprint"] for r in D.simhash_fingerprints(df).collect()}
    assert got == {i: simhash(t or "") for i, t in enumerate(texts)}
    kept, removed = D.deduplicate_by_simhash(df.filter("seq < 3"), 3)
    assert seqs(removed) == {1} and kept.count() == 2


def near_values(n, seed):
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(values) < n:
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.randint(0, 5)):
            v ^= 1 << b
        values.append(v)
    rng.shuffle(values)
    return [v - (1 << 64) if v >= 1 << 63 else v for v in values]


@pytest.mark.parametrize("distance,blocks,limit", [(3, 6, 1000), (3, 4, 1000), (3, 6, 3), (2, 5, 2), (1, 3, 1)])
def test_hamming_against_brute_force(spark, distance, blocks, limit):
    values = near_values(160, distance * 10 + blocks)
    close = lambda i, j: bin((values[i] ^ values[j]) & (2**64 - 1)).count("1") <= distance
    df = spark.createDataFrame(list(enumerate(values)), "seq bigint, fingerprint bigint")
    assert seqs(D.simhash_removed(df, distance, blocks, limit)) == greedy(len(values), close)
    distinct = df.groupBy("fingerprint").agg(F.min("seq").alias("seq"))
    ids = sorted(r["seq"] for r in distinct.collect())
    want = {(i, j) for i, j in itertools.combinations(ids, 2) if close(i, j)}
    got = {(r["lo"], r["hi"]) for r in D.hamming_pairs(distinct, distance, blocks, limit).collect()}
    assert got == want


def cloud(n, seed, dims=8):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dims))
    rows = centers[rng.integers(0, 5, n)] + rng.normal(scale=0.25, size=(n, dims))
    rows[rng.integers(0, n, 4)] = 0
    rows[n // 2] = rows[0]
    rows[: n // 3] = centers[0] + rng.normal(scale=0.01, size=(n // 3, dims))
    rng.shuffle(rows)
    return rows.astype(np.float32)


@pytest.mark.parametrize("threshold,block_rows,pivots", [(0.95, 4096, None), (0.95, 20, 6), (0.8, 15, 12), (0.5, 30, 3), (0.99, 7, 20)])
def test_embeddings_against_brute_force(spark, threshold, block_rows, pivots):
    rows = cloud(150, int(threshold * 100) + block_rows)
    unit = rows.astype(np.float64)
    norms = np.linalg.norm(unit, axis=1, keepdims=True)
    sims = (unit / np.where(norms == 0, 1, norms)) @ (unit / np.where(norms == 0, 1, norms)).T
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "seq bigint, embedding array<float>")
    options = {"block_rows": block_rows, "pivots": pivots}
    assert seqs(S.embedding_removed(df, threshold, **options)) == greedy(len(rows), lambda i, j: sims[i, j] >= threshold)
    got = {(r["lo"], r["hi"]) for r in S.cosine_pairs(df, threshold, **options).collect()}
    assert got == {(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if sims[i, j] >= threshold}


def test_embedding_chain_zero_and_missing(spark):
    angle = np.deg2rad([0, 15, 30])
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angle)]
    rows += [(3, [0.0, 0.0]), (4, [0.0, 0.0]), (5, None)]
    df = spark.createDataFrame(rows, "seq bigint, content_embedding array<float>")
    kept, removed = S.deduplicate_by_embedding(df, 0.95)
    assert seqs(removed) == {1} and seqs(kept) == {0, 2, 3, 4, 5}


def test_no_vectors(spark):
    df = spark.createDataFrame([(0, None)], "seq bigint, content_embedding array<float>")
    kept, removed = S.deduplicate_by_embedding(df)
    assert seqs(kept) == {0} and seqs(removed) == set()


def test_block_pairs_are_sent_in_parts(monkeypatch):
    """Rows routed to many blocks and pairs of large blocks leave a task in bounded batches."""
    import numpy as np
    import pyarrow as pa

    from corpusmill.operators import similarity as S

    n, blocks = 300, 400
    vectors = pa.array(np.ones((n, 2)).tolist(), pa.list_(pa.float32()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), vectors, pa.array(range(n)), pa.array([1] * n)], ["seq", "embedding", "spot", "unit"]
    )
    sent = list(S._route(np.ones((1, 2)) / 2**0.5, {1: 0.1}, {1: blocks}, 0.5)(iter([batch])))
    assert sum(b.num_rows for b in sent) == n * blocks and max(b.num_rows for b in sent) <= S.ROUTED_ROWS
    monkeypatch.setattr(S, "PAIR_ROWS", 1000)
    block = pa.RecordBatch.from_arrays([pa.array([0] * n), pa.array(range(n)), vectors], ["block", "seq", "embedding"])
    found = list(S._compare(0.9)((pa.scalar(0), pa.scalar(0)), iter([block])))
    assert sum(b.num_rows for b in found) == n * (n - 1) // 2 and max(b.num_rows for b in found) <= 1000
