"""Relations in text and lists of relations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.constants import RELATION_VERBS

_NAME = "[A-Z][a-zA-Z]*"
_RELATION = f"({_NAME}) ({'|'.join(RELATION_VERBS)}) ({_NAME})"


def extract_relations(text: Column) -> Column:
    """All non-overlapping ``Name verb Name`` matches, in text order."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(_RELATION), F.lit(0)),
        lambda m: F.struct(
            F.regexp_extract(m, _RELATION, 1).alias("subject"),
            F.regexp_extract(m, _RELATION, 2).alias("relation"),
            F.regexp_extract(m, _RELATION, 3).alias("object"),
        ),
    )


def merge_relations(first: Column, second: Column) -> Column:
    """``first`` as it is, then each new entry of ``second`` once."""
    return F.concat(first, F.array_except(second, first))
