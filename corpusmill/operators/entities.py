"""Entity lookup against a gazetteer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialize

_WORD = r"[\p{L}\p{N}_]+"


def find_entities(docs: DataFrame, gazetteer: DataFrame, max_words: int | None = None) -> DataFrame:
    """Rows (seq, pos, text, type) for every run of words that is a gazetteer name, ``text`` being that name.

    ``docs`` has ``seq`` and ``content``; ``gazetteer`` has ``name`` and ``type``. Names are cut into words like the
    texts, so marks within them ("St. John's") do not matter. Case-sensitive. The run lengths looked up are those that
    the gazetteer has, up to ``max_words`` if given. The join strategy follows the gazetteer's measured size; a large
    one is joined by shuffle.
    """
    words = lambda c: F.regexp_extract_all(c, F.lit(_WORD), F.lit(0))
    names = gazetteer.groupBy("name").agg(F.min("type").alias("type")).withColumn("words", words("name")).filter(F.size("words") > 0)
    if max_words is not None:
        names = names.filter(F.size("words") <= max_words)
    # Written once: its measured size, known before the texts are read, decides whether their words are shuffled at all.
    names = materialize(names.select(F.array_join("words", " ").alias("run"), F.col("name").alias("text"), "type", F.size("words").alias("n")), "names")
    lengths = sorted(names.agg(F.collect_set("n")).first()[0])

    def runs(n: int) -> Column:
        """All runs of ``n`` words with their positions."""
        if n == 1:
            return F.transform("toks", lambda t, i: F.struct(i.alias("pos"), t.alias("run")))
        starts = F.when(F.size("toks") >= n, F.sequence(F.lit(0), F.size("toks") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.alias("pos"), F.array_join(F.slice("toks", i + 1, n), " ").alias("run")))

    none = F.array().cast("array<struct<pos:int,run:string>>")
    grams = F.concat(none, *[runs(n) for n in lengths])
    found = (
        docs.select("seq", words("content").alias("toks"))
        .select("seq", F.explode_outer(grams).alias("g"))  # outer: the grams are computed once
        .select("seq", "g.pos", "g.run")
    )
    return found.join(names, "run").select("seq", "pos", "text", "type")
