"""Steps whose memory, time or disk must not grow faster than their input."""

import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.functions.common import SLICE_ROWS, in_slices
from corpusmill.operators import pages as P
from corpusmill.operators.entities import find_entities
from corpusmill.operators.quality import enrich_records
from corpusmill.operators.sentence_ranks import summarize_exact


def test_python_objects_of_a_few_rows_only():
    seen = []

    def run(part):
        seen.append(len(part))
        return part

    texts = pa.array([None if i % 7 == 0 else f"text {i}" for i in range(10 * SLICE_ROWS + 3)])
    assert in_slices(run, pa.string(), texts).equals(texts)
    assert max(seen) <= SLICE_ROWS and sum(seen) == len(texts)
    assert in_slices(run, pa.string(), texts.slice(0, 0)).equals(pa.array([], pa.string()))


def test_parsed_pages_are_sent_in_parts(spark):
    class Pages:
        columns, schema = ["html"], spark.range(0).select(F.lit("").alias("html")).schema

        def mapInArrow(self, run, ddl):
            return run

    batch = pa.RecordBatch.from_pydict({"html": [f"<figure><img src='{i}'></figure>" for i in range(1000)]})
    found = list(P.parse_pages(Pages(), ("images",))(iter([batch])))
    assert [i[0]["image_url"] for b in found for i in b.column("images").to_pylist()] == [str(i) for i in range(1000)]
    assert max(b.num_rows for b in found) <= SLICE_ROWS


def test_words_are_not_shuffled_for_a_small_gazetteer(spark, capsys):
    docs = spark.createDataFrame([(1, "a New York b"), (2, ""), (3, None), (4, "York New")], "seq bigint, content string")
    many = spark.range(5000).select(F.concat(F.lit("name "), F.col("id") % 3).alias("name"), F.lit("T").alias("type"))
    names = many.unionByName(spark.createDataFrame([("New York", "CITY"), ("York", "CITY")], "name string, type string")).distinct()
    found = find_entities(docs, names)
    assert {tuple(r) for r in found.collect()} == {(1, 1, "New York", "CITY"), (1, 2, "York", "CITY"), (4, 0, "York", "CITY")}
    found.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "hashpartitioning(run" not in plan


def test_texts_are_cleaned_once(spark, capsys):
    records = spark.createDataFrame([(1, "<p>see  York</p>"), (2, None)], "seq bigint, content string")
    names = spark.createDataFrame([("York", "CITY")], "name string, type string")
    out = enrich_records(records, names)
    assert {r["seq"]: (r["clean_content"], len(r["entities"])) for r in out.collect()} == {1: ("see York", 1), 2: (None, 0)}
    out.explain()
    assert "ArrowEvalPython" not in capsys.readouterr().out


def test_micro_batches_are_not_cached(spark, tmp_path, monkeypatch):
    import numpy as np

    from corpusmill.streaming.streams import read_stream, record_stream

    def cached(self, *a):
        raise AssertionError("cached")

    monkeypatch.setattr(type(spark.range(1)), "persist", cached)
    ddl = "seq bigint, title string, text string, lang string, category string, created_at timestamp"
    spark.createDataFrame([(1, "t", "word. " * 100, "en", "c", None), (2, "u", "short", "en", "c", None)], ddl).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    record_stream(read_stream(spark, str(tmp_path / "in"), ddl, "parquet"), out, str(tmp_path / "state"), {"en": []}, np.zeros(16))
    assert spark.read.parquet(f"{out}/rejects").count() == 2
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["records", "rejects"]


def test_exact_summaries_need_no_python(spark, monkeypatch):
    from corpusmill.operators import sentence_ranks

    plans = []
    kept = sentence_ranks.materialize
    monkeypatch.setattr(sentence_ranks, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or kept(df, name))
    docs = spark.createDataFrame([(1, "a a b. c d! e"), (2, "a b. a c"), (3, "")], "seq bigint, content string")
    out = {r["seq"]: r["summary"] for r in summarize_exact(docs, sentences=1).collect()}
    assert out == {1: "e", 2: "a b", 3: ""}
    assert plans and "EvalPython" not in plans[0]


def test_a_bundle_keeps_only_what_it_writes(spark, tmp_path, monkeypatch):
    from corpusmill.plans import records

    kept = []
    persist = type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: kept.append(self.columns) or persist(self, *a))
    path = str(tmp_path / "set.json")
    row = spark.range(1).select(
        F.lit("i").alias("id"), F.lit("t").alias("title"), F.lit("long text").alias("content"), F.array(F.lit("k")).alias("keywords"),
        F.array(F.struct(F.lit("q").alias("text"))).alias("questions"), F.array(F.struct(F.lit("a").alias("text"))).alias("answers"),
    )
    row.write.json(path)
    out = records.training_bundle(spark, path, lines=True)
    assert spark.read.json(out["pairs"]).select("question", "answer").collect() == [("q", "a")]
    assert spark.read.json(out["triples"]).count() == 1
    assert kept and all("content" not in columns for columns in kept)
