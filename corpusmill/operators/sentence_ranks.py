"""Extractive summaries without hashed weights: latent ranks inside the row, and exact document frequencies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.constants import MIN_TEXT_LENGTH, SUMMARY_SENTENCES
from corpusmill.operators.chunks import answered, chunked, coded, column, listed_terms, lists, runs, sizes, text_words
from corpusmill.session import materialize, unstage

_WORD = r"[\p{L}\p{N}]+"
_SENTENCE_END = r"[.!?]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _parts(text: Column) -> Column:
    """The sentences of a text, without blank ones."""
    trimmed = F.transform(F.split(text, _SENTENCE_END), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda s: s != "")


def _chosen(parts: Column, numbers: Column, text: Column) -> Column:
    """The sentences with these numbers (from 0) in text order, or the first characters of a text that has none."""
    joined = F.array_join(F.transform(F.sort_array(numbers), lambda i: F.get(parts, i)), " ")
    return F.when(F.size(parts) > 0, joined).otherwise(F.substring(text, 1, MIN_TEXT_LENGTH))


def latent_rank(words: Column) -> Column:
    """Rank of a sentence in the latent space of its document, from its words.

    The term-by-sentence matrix holds 0.4 + 0.6 * count / highest count of the sentence. A sentence's rank is the length of its
    row of V scaled by the singular values. With all dimensions kept, that is the length of its column of the matrix, whose
    square is 0.16 per term of the document plus 0.48 n / m + 0.36 q / m^2 (n words, m the highest count, q the sum of
    squared counts). The first part is the same for all sentences, so no decomposition is needed: the rank returned is
    (4 n m + 3 q) / m^2, in the order of the length. Counts come from runs of the sorted words, so time is not quadratic in a long one.
    """
    start = F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("most"), F.lit(0).cast("long").alias("squares"))

    def step(acc: Column, word: Column) -> Column:
        run = F.when(word == acc["last"], acc["run"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(
            word.alias("last"), run.alias("run"), F.greatest(acc["most"], run).alias("most"), (acc["squares"] + 2 * run - 1).alias("squares")
        )

    def rank(acc: Column) -> Column:
        n = F.size(words).cast("double")
        most = acc["most"].cast("double")
        return F.when(acc["most"] > 0, (4 * n * most + 3 * acc["squares"].cast("double")) / (most * most)).otherwise(F.lit(0.0))

    return F.aggregate(F.sort_array(words), start, step, rank)


def summarize_latent(docs: DataFrame, content: str = "content", sentences: int = SUMMARY_SENTENCES) -> DataFrame:
    """Add ``summary``: the sentences of the highest latent rank in text order, ties to the earlier one.

    All of it happens inside the row by SQL functions; nothing is fitted, shuffled or sent to the driver. A null text has no
    summary, a text without sentences its first characters.
    """
    text = F.col(content)

    def summary(parts: Column) -> Column:
        ranked = F.transform(parts, lambda s, i: F.struct((-_let(_words(s), latent_rank)).alias("rank"), i.alias("i")))
        best = F.transform(F.slice(F.sort_array(ranked), 1, sentences), lambda r: r["i"])
        return _chosen(parts, best, text)

    return docs.withColumn("summary", F.when(text.isNotNull(), _let(_parts(text), summary)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def _spoken(together: bool):
    """Words of a chunk of texts with the texts that have each, and per text the lengths of its sentences and the places of their words."""

    def encode(table: pa.Table) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
        texts = column(table, "sentences")
        said = texts.flatten()
        names, place = coded(said.flatten())
        n, length = sizes(texts), sizes(said)
        own = runs(column(table, "key"), together)
        row = np.repeat(np.repeat(own, n), length)
        width = max(1, len(names))
        having = np.unique(row * width + place) % width
        return names, np.bincount(having, minlength=len(names)), [x.astype(np.int32) for x in (n, length, place)]

    return encode


def _best_sentences(total: float, sentences: int, together: bool):
    """The numbers of the best sentences of each text, from the document frequencies of its words, 1 where none is given."""

    def decode(keys: pa.Array, terms: pa.Array, body: list[np.ndarray], pos: np.ndarray, value: np.ndarray) -> pa.Table:
        n, length, place = body
        df = np.ones(len(terms))
        df[pos.astype(np.int64)] = value
        text = np.repeat(runs(keys, together), n)
        number = np.arange(len(length)) - np.repeat(np.cumsum(n) - n, n)
        summed = np.bincount(np.repeat(np.arange(len(length)), length), weights=np.log((total + 1) / (df + 1))[place], minlength=len(length))
        said = np.flatnonzero(length)
        text, number, length, summed = text[said], number[said], length[said], summed[said]
        if together:
            # Sentences of one number in rows of one key count as one, over the length of the first.
            _, first, same = np.unique(text * (number.max(initial=0) + 1) + number, return_index=True, return_inverse=True)
            summed = np.bincount(same, weights=summed, minlength=len(first))
            text, number, length = text[first], number[first], length[first]
        score = np.round(summed / length, 9)
        order = np.lexsort((number, -score, text))
        text, number = text[order], number[order]
        place = np.arange(len(text)) - np.searchsorted(text, text)
        text, number = text[place < sentences], number[place < sentences]
        found, ends = np.unique(text, return_counts=True)
        own = keys.take(pa.array(np.searchsorted(runs(keys, together), found)))
        return pa.Table.from_arrays([own, lists(np.cumsum(ends), number.astype(np.int32))], names=["key", "_numbers"])

    return decode


def summarize_exact(docs: DataFrame, content: str = "content", key: str = "seq", sentences: int = SUMMARY_SENTENCES) -> DataFrame:
    """Add ``summary``: the sentences of the highest mean inverse document frequency, ln((N + 1) / (df + 1)), exact for any vocabulary.

    ``key`` must be unique. Document frequencies stay a table: each chunk of texts asks for those of its own words, once for each. Neither the
    driver nor a task holds the whole vocabulary. Texts move once, to their chosen sentences.
    """
    text = F.col(content)
    counts = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n"), F.max(F.when(F.col(key).isNotNull(), F.col("n"))).alias("most")).first()
    together = (counts["most"] or 0) > 1
    # Texts without a key are counted but have no frequencies and no ranks of their own.
    spoken = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.transform(_parts(text), _words).alias("sentences"))
    chunks = chunked(spoken, "key", lambda batch: text_words(batch.column("sentences")), _spoken(together), together, "sentence_terms")
    df = F.sum("n").over(Window.partitionBy("term"))
    frequent = listed_terms(chunks).select("chunk", "pos", df.alias("value")).filter("value > 1")
    ddl = f"key {docs.schema[key].dataType.simpleString()}, _numbers array<int>"
    numbers = answered(chunks, frequent, _best_sentences(float(counts["n"] or 0), sentences, together), ddl)
    numbers = materialize(numbers.withColumnRenamed("key", key), "numbers")
    unstage(chunks)
    joined = docs.join(numbers, key, "left")
    found = F.coalesce("_numbers", F.array().cast("array<int>"))

    def summary(parts: Column) -> Column:
        # Where fewer sentences than wanted have words, the first ones without follow.
        others = F.filter(F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0))), lambda i: ~F.array_contains(found, i))
        return _chosen(parts, F.slice(F.concat(found, F.slice(others, 1, sentences)), 1, sentences), text)

    return joined.withColumn("summary", F.when(text.isNotNull(), _let(_parts(text), summary))).drop("_numbers")
