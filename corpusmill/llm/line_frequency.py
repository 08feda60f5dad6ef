r"""Quality rules with cross-document line frequency.

Lines are normalised (lower case, runs of white space as one blank, digit runs as 0) and hashed. Per host, the documents
that hold a line are counted; a line of more than ``MAX_DOCUMENTS`` documents is boilerplate there and is removed, except
from the document with the smallest id, so that no content vanishes as a whole. A document that loses more than
``MAX_LOST`` of its characters is depleted and rejected, as is one that fails the base rules.

Native column functions only. Lines travel as 64-bit hashes. Counting folds per task first, so a line of a third of all
documents is one row a task; the join back is split by AQE where one line is that common.

Defined results: null and empty texts have no words and lines and fail the base rules; lines without a word are never
counted; equal lines of a document count once for frequency and are all removed; a null host is a host of its own; rows
with equal ids are one document, and share its loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DOCUMENTS = 20
MAX_LOST = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

WORD_GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def lines_of(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(HAS_WORD))


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), WORD_GAP, " "), "[0-9]+", "0"))


def base_columns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``.

    Repeated windows are found by sorting (hash, position) of a document's windows, neighbours being equal ones.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.withColumns({"__words": words_of(text), "__lines": lines_of(text)})
    w = F.col("__words")
    n = F.size(w)
    windows = F.slice(
        F.arrays_zip(w.alias("a"), F.slice(w, F.lit(2), F.greatest(n, F.lit(1))).alias("b"), F.slice(w, F.lit(3), F.greatest(n, F.lit(1))).alias("c")),
        F.lit(1), F.greatest(n - 2, F.lit(0)),
    )
    step = step.withColumn(
        "__sorted",
        F.sort_array(F.transform(windows, lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i")))),
    )
    s = F.col("__sorted")
    both = F.arrays_zip(s.alias("x"), F.slice(s, F.lit(2), F.greatest(F.size(s), F.lit(1))).alias("y"))
    equal = F.filter(both, lambda p: p["x"]["h"] == p["y"]["h"])
    step = step.withColumn("__equal", equal)
    at = F.sort_array(F.array_distinct(F.concat(F.col("__equal.x.i"), F.col("__equal.y.i"))))
    step = step.withColumn("__at", at)
    a = F.col("__at")
    steps = F.arrays_zip(a.alias("p"), F.slice(a, F.lit(2), F.greatest(F.size(a), F.lit(1))).alias("q"))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda acc, p: acc + F.least(F.coalesce(p["q"] - p["p"], F.lit(3)), F.lit(3)))
    out = step.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def document_lines(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(id, host, line hash, characters of all such lines) once per document and line; hosts are marked, so that null is one more."""
    lines = F.transform(
        lines_of(F.coalesce(F.col(text_col), F.lit(""))),
        lambda line: F.struct(F.xxhash64(normalised(line)).alias("line"), F.length(F.trim(line)).cast("long").alias("chars")),
    )
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")).alias("host"), F.explode(lines).alias("l"))
    return rows.groupBy("host", "l.line", "id").agg(F.sum("l.chars").alias("chars"))


def frequent_lines(lines: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(host, line, documents, first) of the lines in more than ``max_documents`` documents of a host."""
    counted = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_documents"), F.min("id").alias("first"))
    return counted.filter(F.col("n_documents") > max_documents)


def line_losses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_documents: int = MAX_DOCUMENTS,
) -> DataFrame:
    """(id, lines, line_chars, lost_chars, lost): what each document with lines loses; ``lost`` has the line hashes."""
    lines = document_lines(docs, id_col, text_col, host_col)
    known = lines.join(frequent_lines(lines, max_documents), ["host", "line"], "left")
    gone = F.col("n_documents").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return known.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("chars").alias("line_chars"),
        F.sum(F.when(gone, F.col("chars")).otherwise(0)).alias("lost_chars"),
        F.collect_set(F.when(gone, F.col("line"))).alias("lost"),
    )


def quality_verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    max_documents: int = MAX_DOCUMENTS, max_lost: float = MAX_LOST,
) -> DataFrame:
    """Base columns, ``lost_chars``, ``base_failed`` and ``kept`` of every row."""
    base = base_columns(docs.select(id_col, text_col), text_col).drop(text_col)
    losses = line_losses(docs, id_col, text_col, host_col, max_documents).select(F.col("id").alias("__id"), "line_chars", "lost_chars")
    joined = base.join(losses, base[id_col].eqNullSafe(losses["__id"]), "left").drop("__id")
    lost = F.coalesce("lost_chars", F.lit(0))
    depleted = lost > max_lost * F.coalesce("line_chars", F.lit(0))
    return joined.withColumns({"lost_chars": lost, "kept": ~(F.col("base_failed") | depleted)}).drop("line_chars")


def remove_frequent_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_documents: int = MAX_DOCUMENTS,
) -> DataFrame:
    """``docs`` without the lines that are frequent in their host; texts that lose nothing stay byte for byte."""
    losses = line_losses(docs, id_col, text_col, host_col, max_documents).filter("lost_chars > 0").select(F.col("id").alias("__id"), F.col("lost").alias("__lost"))
    joined = docs.join(losses, docs[id_col].eqNullSafe(losses["__id"]), "left")
    left = F.filter(F.split(text_col, "\n"), lambda line: ~(line.rlike(HAS_WORD) & F.array_contains("__lost", F.xxhash64(normalised(line)))))
    text = F.when(F.col("__lost").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return joined.withColumn(text_col, text).drop("__id", "__lost")
