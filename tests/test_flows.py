import json

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.categories import work_grid
from corpusmill.plans import records as R
from corpusmill.schema import ENTITY_PAYLOAD_DDL, JOB_DDL, QA_PAYLOAD_DDL
from corpusmill.sinks import writers as W
from corpusmill.sources import payloads as P
from corpusmill.sources import registry
from corpusmill.sources.tables import read_jobs, read_records, read_url_list
from corpusmill.streaming import streams as S

RECORD = {
    "id": "1", "title": "T", "language": "en", "category": "c", "topic": "ai", "subtopic": "nlp", "keywords": ["k1", "k2"],
    "content": "café [1]", "summary": "s", "content_embedding": [0.5, 1.0], "summary_embedding": [0.5],
    "questions": [{"text": "q1", "type": "t", "difficulty": "easy"}, "q2"], "answers": ["a1"], "relations": [],
    "created_at": "2024-01-01T00:00:00", "metadata": {"length": 3, "source": "wikipedia", "source_url": "u"},
}


def dump(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_read_records(spark, tmp_path):
    path = dump(tmp_path / "r.json", [RECORD, {**RECORD, "id": "2", "questions": None}])
    rows = read_records(spark, path).orderBy("id").collect()
    assert [q["text"] for q in rows[0]["questions"]] == ["q1", "q2"] and rows[0]["questions"][0]["difficulty"] == "easy"
    assert rows[0]["answers"][0]["text"] == "a1" and rows[0]["metadata"]["source_url"] == "u" and rows[1]["questions"] is None
    assert read_records(spark, str(tmp_path / "none.json"), missing_ok=True).count() == 0
    with pytest.raises(Exception):
        read_records(spark, str(tmp_path / "none.json"))


def test_writers(spark, tmp_path):
    df = read_records(spark, dump(tmp_path / "r.json", [RECORD]))
    out = str(tmp_path / "out")
    assert len(W.write_dataset(df, out, "all")) == 4
    line = json.loads(spark.read.text(f"{out}/jsonl").first()[0])
    assert line["id"] == "1" and line["content"] == "café [1]"
    row = spark.read.option("header", True).option("escape", '"').csv(f"{out}/csv").first()
    assert json.loads(row["keywords"]) == ["k1", "k2"]
    assert spark.read.parquet(f"{out}/parquet").first()["keywords"] == ["k1", "k2"]
    W.write_dataset(df, out, "qa")
    pair = spark.read.json(f"{out}/qa").first()
    assert (pair["question"], pair["answer"]) == ("q1", "a1")
    W.write_text_corpus(df, f"{out}/text", layout="text")
    assert spark.read.text(f"{out}/text/name=1").first()[0] == "café"
    assert json.loads(W.json_rows(df).first()["data"])["title"] == "T"
    W.append_blobs(df, f"{out}/blobs")
    W.append_blobs(df, f"{out}/blobs")
    blobs = spark.read.parquet(f"{out}/blobs").collect()
    assert len(blobs) == 2 and json.loads(blobs[0]["data"])["metadata"]["length"] == 3
    W.write_progress(spark.createDataFrame([(5,)], "pages_processed long"), f"{out}/progress")
    assert W.read_progress(spark, f"{out}/progress", "pages_processed long").first()["pages_processed"] == 5
    with pytest.raises(ValueError):
        W.write_dataset(df, out, "nope")


def test_text_corpus_names(spark):
    df = spark.createDataFrame([("1", "t", "x"), ("", "t", "x"), (None, None, None)], "id string, title string, content string")
    assert [r["name"] for r in W.text_corpus(df).collect()] == ["1", "t", "record"]


def test_training_bundle(spark, tmp_path):
    path = dump(tmp_path / "data.json", [RECORD])
    targets = R.training_bundle(spark, path)
    assert targets["pairs"].endswith("data_pairs")
    assert spark.read.json(targets["triples"]).orderBy("object").first()["object"] == "k1"
    assert spark.read.json(targets["embeddings"]).first()["embedding"] == [0.5, 1.0]


def test_url_list_and_jobs(spark, tmp_path):
    urls = dump(tmp_path / "u.txt", "https://en.wikipedia.org/wiki/A_b\n\n  https://pt.wikipedia.org/wiki/C \n")
    assert [(r["title"], r["lang"]) for r in read_url_list(spark, urls).orderBy("url").collect()] == [("A_b", "en"), ("C", "pt")]
    jobs = dump(tmp_path / "j.jsonl", '{"lang": ["en"], "category": ["Programming"], "format": "json"}\n{"lang": null, "category": null, "format": "csv"}\n')
    grid = work_grid(read_jobs(spark, jobs), ["en", "pt"], ["DevOps"]).collect()
    assert {(r["format"], r["lang"], r["category"]) for r in grid} == {("json", "en", "Programming"), ("csv", "en", "DevOps"), ("csv", "pt", "DevOps")}


def test_payloads(spark):
    qa = spark.createDataFrame([("en", "python", [("Q1", "<p>Body</p>", 5, "l")])], QA_PAYLOAD_DDL)
    row = P.parse_qa_items(P.qa_items(qa)).first()
    assert row.asDict() == {"title": "Q1", "language": "en", "category": "python", "score": 5, "link": "l", "content": "Body"}
    text = json.dumps({
        "lang": "en", "category": "c", "search": [{"id": "Q1", "label": "l", "description": "d"}, {"label": "no id"}],
        "entities": {"Q1": {"labels": {"en": {"value": "L"}}, "claims": {"P18": [{"mainsnak": {"datavalue": {"value": "Pic.jpg"}}}]}}},
    })
    payload = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", ENTITY_PAYLOAD_DDL).alias("p")).select("p.*")
    rows = P.parse_entity_items(P.entity_items(payload), P.entity_details(payload)).collect()
    assert [r.asDict() for r in rows] == [{
        "title": "L", "language": "en", "category": "c", "description": "d", "wikidata_id": "Q1",
        "image_url": "https://commons.wikimedia.org/wiki/Special:FilePath/Pic.jpg",
    }]
    revs = json.dumps({"query": {"pages": {"1": {"revisions": [{"timestamp": "t", "user": "u"}]}, "2": {}}}})
    df = spark.createDataFrame([("k", revs), ("n", "{}")], "key string, payload string")
    got = {r["key"]: [tuple(x) for x in r["revisions"]] for r in P.revisions(df, "key").collect()}
    assert got == {"k": [("t", "u")], "n": []}
    related = json.dumps({"query": {"pages": {"1": {"links": [{"ns": 0, "title": "A"}, {"ns": 14, "title": "B"}]}}}})
    assert [r["title"] for r in P.related_pages(spark.createDataFrame([("en", related)], "lang string, payload string")).collect()] == ["A"]


def test_registry(spark, tmp_path):
    items = spark.createDataFrame([("en", "a", "x"), ("pt", "a", "y"), ("en", "b", "")], "lang string, category string, v string")
    registry.register_source(
        "toy", lambda s, grid: items.join(grid.select("lang", "category"), ["lang", "category"], "left_semi"), lambda i: i.filter("v <> ''")
    )
    grid = work_grid(spark.createDataFrame([(["en"], ["a", "b"], "json")], JOB_DDL))
    out = R.run_source(spark, "toy", grid, str(tmp_path / "o"), "json")
    assert [r["v"] for r in out.collect()] == ["x"] and spark.read.json(str(tmp_path / "o/json")).count() == 1
    with pytest.raises(ModuleNotFoundError):
        registry.load_source("no_such_source_module")


def test_build_and_quality_pass(spark):
    text = "Deep learning is a field. Ada worked at IBM in the city. " * 8
    data = [(0, "A", text, "en", "c"), (1, "B", text + " More words here.", "en", "c"), (2, "C", "too short", "en", "c"),
            (3, "D", "Completely other content about gardens and rivers and stones. " * 6, "pt", "c"), (4, "A", text, "en", "c")]
    pages = spark.createDataFrame(data, "seq bigint, title string, text string, lang string, category string")
    built = R.build_records(pages, {"en": ["the", "is", "a"]})
    assert {r["seq"] for r in built.select("seq").collect()} == {0, 1, 3, 4}
    one = built.filter("seq = 0").first()
    assert one["topic"] == "ai" and one["relations"][0]["object"] == "IBM" and one["metadata"]["length"] == len(one["content"])
    result = R.quality_pass(built, threshold=0.9999)
    counts = {r["stage"]: r["removed"] for r in result.accounting.collect()}
    assert counts["hash"] == 1 and set(counts) == {"hash", "embedding", "semantics", "simhash", "save"}
    kept = result.records.count()
    snap = result.progress.first()
    assert snap["duplicates_removed"] == counts["hash"] + counts["embedding"] and snap["pages_processed"] == kept + counts["simhash"] + counts["save"]


EVENTS = "ts timestamp, kind string"


def at(minute):
    return f"2024-01-01 00:{minute:02d}:00"


def events(spark, data):
    return spark.createDataFrame(data, "ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp"))


def test_error_alert_holds(spark):
    data = [(at(m), "error") for m in range(0, 20)] + [(at(m), "success") for m in range(20, 40)] + [("2024-01-01 02:00:00", "other")]
    rates = S.error_rates(events(spark, data), F.col("kind") == "success", F.col("kind") == "error", "5 minutes", "5 minutes")
    assert {r["error_rate"] for r in rates.filter("window_start >= '2024-01-01 02:00:00'").collect()} == {0.0}
    fired = sorted(str(r["fired_at"]) for r in S.error_rate_alerts(rates, 300, 600).collect())
    assert fired == ["2024-01-01 00:15:00", "2024-01-01 00:20:00"]


def test_stall_alert(spark):
    df = events(spark, [(at(0), "success"), (at(1), "error"), (at(45), "success")])
    counts = S.success_counts(df, S.heartbeat_grid(df, 600), F.col("kind") == "success", "10 minutes", "10 minutes")
    fired = sorted(str(r["fired_at"]) for r in S.stall_alerts(counts, 600, 600).collect())
    assert fired == ["2024-01-01 00:30:00", "2024-01-01 00:40:00"]


def test_streams_equal_batches(spark, tmp_path):
    data = [(at(m), k) for m, k in [(0, "a"), (1, "a"), (3, "b"), (7, "a"), (12, "b"), (40, "a")]]
    source = str(tmp_path / "in")
    events(spark, data).repartition(3).write.parquet(source)
    stream = S.read_stream(spark, source, EVENTS, "parquet")
    seen = S.run_available(S.first_seen(stream, ["kind"], "2 hours"), str(tmp_path / "seen"), str(tmp_path / "c1"))
    assert sorted(r["kind"] for r in seen.collect()) == ["a", "b"]
    grid = S.success_counts(stream, _beats(spark, tmp_path), F.col("kind") == "a", "5 minutes", "5 minutes", "1 minute")
    got = S.run_available(grid, str(tmp_path / "grid"), str(tmp_path / "c2"))
    want = S.success_counts(events(spark, data), spark.read.parquet(str(tmp_path / "beats")), F.col("kind") == "a", "5 minutes", "5 minutes")
    closed = {(str(r[0]), r["successes"]) for r in want.filter("window_end <= '2024-01-01 00:39:00'").collect()}
    assert {(str(r[0]), r["successes"]) for r in got.collect()} == closed


def _beats(spark, tmp_path):
    spark.sql("SELECT explode(sequence(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:40:00', interval 5 minutes)) AS beat").write.parquet(
        str(tmp_path / "beats")
    )
    return spark.readStream.schema("beat timestamp").parquet(str(tmp_path / "beats"))


def test_record_stream_is_idempotent(spark, tmp_path):
    from corpusmill.operators.summaries import fit_idf

    text = "Some sentence about rivers. Another sentence about stones and gardens. " * 5
    pages = spark.createDataFrame([(0, "A", text, "en", "c"), (1, "B", "short", "en", "c")], "seq bigint, title string, text string, lang string, category string")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages.write.parquet(source)
    idf = fit_idf(pages.withColumnRenamed("text", "content"))
    stream = S.read_stream(spark, source, pages.schema, "parquet")
    S.record_stream(stream, out, str(tmp_path / "ck1"), {}, idf)
    S.record_stream(S.read_stream(spark, source, pages.schema, "parquet"), out, str(tmp_path / "ck2"), {}, idf)
    good = spark.read.parquet(f"{out}/records").count()
    bad = spark.read.parquet(f"{out}/rejects").collect()
    assert good + len(bad) == 2 and all(r["reasons"] for r in bad) and "content" in {r["title"]: r["reasons"] for r in bad}["B"]
