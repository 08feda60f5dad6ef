"""Words in chunks: what is sent and written must not be each word of each text."""

import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill import session
from corpusmill.operators import chunks, sentence_ranks, terms
from corpusmill.operators.sentence_ranks import summarize_exact

DDL = "seq bigint, content string"


@pytest.mark.parametrize("values", [np.arange(5000) ** 2, np.zeros(0, np.int32), np.array([1.5, -2.0, math.inf], np.float32)])
def test_packed_numbers_come_back(values):
    again = chunks.unpack(chunks.pack(values))
    assert again.dtype == values.dtype and (again == values).all()
    assert len(values) < 5000 or len(chunks.pack(values)) < values.nbytes / 2


def test_words_are_placed_in_ascending_order():
    names, place = chunks.coded(pa.array(["b", "é", "a", "b", "Z"]))
    assert names.to_pylist() == ["Z", "a", "b", "é"] and place.tolist() == [2, 3, 1, 2, 0]


def test_chunks_are_bounded_and_keep_keys_together(monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_WORDS", 10)
    batches = [pa.RecordBatch.from_pydict({"key": [1, 1, 1, 2, 3]}), pa.RecordBatch.from_pydict({"key": [3, 3, 4]})]
    words = lambda batch: np.full(batch.num_rows, 6)
    split = lambda together: [t.column("key").to_pylist() for t in chunks._pieces(iter(batches), "key", words, together)]
    assert split(False) == [[1, 1], [1, 2], [3, 3], [3, 4]]
    assert split(True) == [[1, 1, 1], [2, 3, 3, 3], [4]]


@pytest.fixture
def written(monkeypatch):
    """Rows of each table that is written, by its name."""
    rows = Counter()
    keep = session.materialize

    def counted(df, name):
        out = keep(df, name)
        rows[name] += out.count()
        return out

    for module in (chunks, sentence_ranks, terms):
        monkeypatch.setattr(module, "materialize", counted)
    return rows


def test_summaries_write_no_row_a_word(spark, written):
    """Forty texts of 500 words from a list of 50."""
    rng = random.Random(3)
    rows = [(i, ". ".join(" ".join(f"w{rng.randrange(50)}" for _ in range(10)) for _ in range(50))) for i in range(40)]
    out = {r["seq"]: r["summary"] for r in summarize_exact(spark.createDataFrame(rows, DDL), sentences=2).collect()}
    df = Counter(w for _, text in rows for w in set(text.replace(".", "").split()))
    for seq, text in rows:
        parts = text.split(". ")
        score = lambda s: round(sum(math.log(41 / (df[w] + 1)) for w in s.split()) / len(s.split()), 9)
        best = sorted(sorted(range(len(parts)), key=lambda i: (-score(parts[i]), i))[:2])
        assert out[seq] == " ".join(parts[i] for i in best)
    assert written["numbers"] == 40 and sum(written.values()) < 100


def test_summaries_of_rows_with_one_key(spark):
    """Rows of one key share their sentences by number and count once in the frequencies; rows without a key have no ranks."""
    rows = [(1, "a b. c. d"), (1, "a b. c. d"), (2, "a a. b c"), (None, "a. c. e"), (None, None), (3, "")]
    out = sorted(((r["seq"] or 0, r["content"] or "", r["summary"]) for r in summarize_exact(spark.createDataFrame(rows, DDL), sentences=1).collect()), key=str)
    assert out == [(0, "", None), (0, "a. c. e", "a"), (1, "a b. c. d", "d"), (1, "a b. c. d", "d"), (2, "a a. b c", "a a"), (3, "", "")]


def test_tables_that_no_plan_reads_are_deleted(spark, tmp_path):
    kept = session.materialize(spark.range(3).toDF("seq"), "kept")
    gone = session.materialize(spark.range(3).toDF("seq"), "gone")
    folder = Path(kept._staged.removeprefix("file:"))
    session.unstage(gone)
    assert folder.exists() and not Path(gone._staged.removeprefix("file:")).exists() and kept.count() == 3


def test_shuffle_files_end_with_the_job_that_writes_a_table(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    table = session.materialize(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert table.count() == 7 and spark.conf.get(name) == before


def test_vectors_write_no_row_a_word(spark, written):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(80)}" for _ in range(300))) for i in range(40)]
    found = {r["seq"]: dict(zip(r["terms"], r["weights"])) for r in terms.term_vectors(spark.createDataFrame(rows, DDL)).collect()}
    df = Counter(w for _, text in rows for w in set(text.split()))
    for seq, text in rows:
        raw = {w: n * math.log(41 / (df[w] + 1)) for w, n in Counter(text.split()).items() if df[w] < 40}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        assert found[seq] == pytest.approx({w: x / norm for w, x in raw.items()}, abs=1e-6)
    assert 0 < sum(written.values()) < 40


def test_vectors_of_rows_with_one_key(spark):
    """Each row of a key lists its own terms and counts in the frequencies; rows without a key are one vector."""
    rows = [(1, "a b b"), (1, "a c"), (2, "b c d"), (None, "d e"), (None, "e"), (3, None)]
    found = {r["seq"]: (r["terms"], r["weights"]) for r in terms.term_vectors(spark.createDataFrame(rows, DDL)).collect()}
    raw = {1: [("a", 1), ("a", 1), ("b", 2), ("c", 1)], 2: [("b", 1), ("c", 1), ("d", 1)], None: [("d", 1), ("e", 1), ("e", 1)]}
    assert set(found) == set(raw)
    for key, entries in raw.items():
        w = [n * math.log(7 / 3) for _, n in entries]
        assert found[key][0] == [t for t, _ in entries]
        assert found[key][1] == pytest.approx([x / math.sqrt(sum(y * y for y in w)) for x in w], abs=1e-6)


def test_whole_vectors_are_sent_for_few_pairs(spark, written):
    """Three vectors each share a rare term, but what their heads share and what may follow is not 0.9."""
    rows = []
    for i in range(30):
        own = {f"s{i // 3}": 0.02, **{f"m{j}_{i % 3}": 0.046 for j in range(5)}, "c": 0.75}
        rows.append((i, sorted(own), [math.sqrt(own[t]) for t in sorted(own)]))
    found = terms.sparse_cosine_pairs(spark.createDataFrame(rows, "seq bigint, terms array<string>, weights array<double>"), 0.9).collect()
    assert {(r["lo"], r["hi"]) for r in found} == {(i, j) for i in range(30) for j in range(i + 3, 30, 3)}
    assert all(r["cosine"] == pytest.approx(0.98) for r in found)
    assert written["near"] == 135 and written["met"] == 165
