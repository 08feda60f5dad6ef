"""Summaries by latent ranks and exact frequencies, held against a decomposition and a plain loop."""

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from corpusmill.operators.sentence_ranks import latent_rank, summarize_exact, summarize_latent

_VOCABULARY = ["ash", "birch", "cedar", "Elm", "fir", "gum", "holly", "larch", "maple", "oak"]


def _texts(n=40):
    rnd = random.Random(3)
    texts = []
    for _ in range(n):
        sentences = [" ".join(rnd.choices(_VOCABULARY, k=rnd.randint(1, 9))) for _ in range(rnd.randint(1, 8))]
        texts.append(rnd.choice(["", "  "]) + rnd.choice([". ", "!? ", ".\n"]).join(sentences) + rnd.choice(["", ".", " --- ."]))
    return texts + ["", "...", " -- . ++ . one", "same. same. same. same."]


def _parts(text):
    return [s.strip() for s in re.split(r"[.!?]+", text) if s.strip()]


def _words(sentence):
    return re.findall(r"[^\W_]+", sentence.lower())


def _lengths(text):
    """Ranks from the singular value decomposition of the smoothed term-by-sentence matrix."""
    lists = [_words(s) for s in _parts(text)]
    terms = sorted({w for x in lists for w in x})
    if not terms:
        return [0.0] * len(lists)
    matrix = np.array([[float(x.count(t)) for x in lists] for t in terms])
    most = matrix.max(axis=0)
    full = most > 0
    matrix[:, full] = 0.4 + 0.6 * matrix[:, full] / most[full]
    _, sigma, v = np.linalg.svd(matrix, full_matrices=False)
    return list(np.sqrt((sigma**2) @ (v**2)))


def _best(text, scores, n=3):
    parts = _parts(text)
    chosen = sorted(sorted(range(len(parts)), key=lambda i: (-round(scores[i], 9), i))[:n])
    return " ".join(parts[i] for i in chosen) or text[:150]


def test_latent_rank_is_the_length_in_the_decomposition(spark):
    text = "oak oak fir. ash. ash elm oak gum. fir fir fir fir larch"
    df = spark.createDataFrame([(_words(s),) for s in _parts(text)], "words array<string>").coalesce(1)
    ranks = [r[0] for r in df.select(latent_rank(F.col("words"))).collect()]
    n_terms = len(set(_words(text)))
    assert np.allclose([math.sqrt(0.16 * n_terms + 0.12 * r) for r in ranks], _lengths(text))


def test_latent_summaries(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)) + [(len(texts), None)], "seq int, content string")
    got = {r["seq"]: r["summary"] for r in summarize_latent(docs).collect()}
    assert got.pop(len(texts)) is None
    assert got == {i: _best(t, _lengths(t)) for i, t in enumerate(texts)}
    assert "Exchange" not in summarize_latent(docs)._jdf.queryExecution().executedPlan().toString()


def test_exact_summaries(spark):
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)] + [(len(texts), None, "kept")], "seq int, content string, s string")
    df = {}
    for t in texts:
        for w in set(_words(t)):
            df[w] = df.get(w, 0) + 1

    def scores(text):
        weights = [[math.log((len(texts) + 2) / (df[w] + 1)) for w in _words(s)] for s in _parts(text)]
        return [sum(x) / len(x) if x else -1.0 for x in weights]

    rows = summarize_exact(docs).collect()
    assert {r["s"] for r in rows} == {"kept"}
    got = {r["seq"]: r["summary"] for r in rows}
    assert got.pop(len(texts)) is None
    assert got == {i: _best(t, scores(t)) for i, t in enumerate(texts)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "seq int, content string")
    assert summarize_latent(none).columns == summarize_exact(none).columns == ["seq", "content", "summary"]
    assert summarize_latent(none).collect() == summarize_exact(none).collect() == []
