"""Extractive summaries: the sentences with the highest mean inverse document frequency."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from corpusmill.constants import MIN_TEXT_LENGTH, SUMMARY_SENTENCES
from corpusmill.functions.common import in_slices

HASH_DIGITS = 4
_WORD = re.compile(r"[^\W_]+")
_SENTENCE_END = re.compile(r"[.!?]+")


class _Buckets(dict):
    """Term -> number of its bucket: the first hex digits of its md5. Filled on first use."""

    def __init__(self, digits: int):
        self.digits = digits

    def __missing__(self, term: str) -> int:
        value = self[term] = int(hashlib.md5(term.encode("utf-8", "surrogatepass")).hexdigest()[: self.digits], 16)
        return value


def _document_buckets(content: str, digits: int) -> Column:
    @F.arrow_udf(ArrayType(IntegerType()))
    def buckets(texts: pa.Array) -> pa.Array:
        bucket = _Buckets(digits)
        found = lambda part: [list({bucket[w] for w in _WORD.findall((t or "").lower())}) for t in part]
        return in_slices(found, pa.list_(pa.int32()), texts)

    return buckets(content)


def fit_idf(docs: DataFrame, content: str = "content", digits: int = HASH_DIGITS) -> np.ndarray:
    """Inverse document frequency of every term bucket, ln((N + 1) / (df + 1)).

    Runs one job. Like a fitted model, the result comes to the driver; its size, 16^digits numbers, does not
    depend on the corpus or its vocabulary. Map tasks send at most one count per bucket.
    """
    marked = docs.select(F.explode(F.concat(_document_buckets(content, digits), F.array(F.lit(-1)))).alias("bucket"))
    counts = marked.groupBy("bucket").agg(F.count(F.lit(1)).alias("df")).collect()
    df = np.zeros(16**digits + 1)
    df[[r["bucket"] for r in counts]] = [r["df"] for r in counts]
    return np.log((df[-1] + 1) / (df[:-1] + 1))


def summarize(
    docs: DataFrame,
    content: str = "content",
    sentences: int = SUMMARY_SENTENCES,
    idf: np.ndarray | None = None,
) -> DataFrame:
    """Add ``summary``: the best sentences in text order, or the first characters of a text without any.

    Scoring happens inside each row with the idf vector (of ``docs``, unless one is given) as a broadcast
    variable: no text is shuffled.
    """
    vector = fit_idf(docs, content) if idf is None else idf
    digits = round(np.log2(len(vector)) / 4)
    shared = docs.sparkSession.sparkContext.broadcast(vector)

    @F.arrow_udf(StringType())
    def summary(texts: pa.Array) -> pa.Array:
        weights, bucket = shared.value.tolist(), _Buckets(digits)

        def score(sentence: str) -> float:
            words = _WORD.findall(sentence.lower())
            return round(sum([weights[bucket[w]] for w in words]) / len(words), 9) if words else 0.0

        def best(text: str) -> str:
            parts = [s for p in _SENTENCE_END.split(text) if (s := p.strip())]
            ranked = sorted(range(len(parts)), key=[-score(s) for s in parts].__getitem__)
            return " ".join(parts[i] for i in sorted(ranked[:sentences])) or text[:MIN_TEXT_LENGTH]

        return in_slices(lambda part: [None if t is None else best(t) for t in part], pa.string(), texts)

    return docs.withColumn("summary", summary(content))
