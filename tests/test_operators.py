import math
import random
from collections import deque

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corpusmill.operators import categories as C
from corpusmill.operators import fill, ordering, quality, stats, vectors, walks
from corpusmill.operators.entities import find_entities
from corpusmill.operators.summaries import summarize


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ------------------------------------------------------------------ fill


def test_fill_adds_columns(spark):
    ours = spark.createDataFrame([("Python", "en")], "title string, language string")
    extra = spark.createDataFrame([("Python", "en", "Q1", "img", 0)], "title string, language string, wikidata_id string, image_url string, extra_seq int")
    assert fill.complete_missing_fields(ours, extra).first().asDict() == {
        "title": "Python", "language": "en", "wikidata_id": "Q1", "image_url": "img",
    }


def test_fill_rules(spark):
    ddl = "title string, language string, a string, tags array<string>, n int, metadata struct<x:string,y:int>"
    ours = spark.createDataFrame(
        [("t", None, "", [], 0, Row(x="", y=None)), ("t", "en", "own", ["z"], None, Row(x="mine", y=1)), ("u", "en", None, None, None, None)], ddl
    )
    extra = spark.createDataFrame(
        [("t", None, "old", ["o"], 8, Row(x="o", y=8), 0), ("t", None, "new", ["n"], 9, Row(x="n", y=9), 1), ("t", "en", "E", ["e"], 7, Row(x="e", y=7), 2)],
        ddl + ", extra_seq int",
    )
    got = {(r["title"], r["language"]): r for r in fill.complete_missing_fields(ours, extra).collect()}
    r = got[("t", None)]
    assert (r["a"], r["tags"], r["n"], tuple(r["metadata"])) == ("new", ["n"], 0, ("n", 9))
    r = got[("t", "en")]
    assert (r["a"], r["tags"], r["n"], tuple(r["metadata"])) == ("own", ["z"], 7, ("mine", 1))
    assert got[("u", "en")]["a"] is None


def test_last_good(spark):
    requests = spark.createDataFrame([("a", "new"), ("b", None), ("c", None), ("d", None)], "key string, fresh string")
    snaps = spark.createDataFrame(
        [("a", "x", 1, None), ("b", "old", 1, None), ("b", "mid", 2, "2024-01-05"), ("b", "late", 3, "2023-12-01"), ("c", "gone", 1, "2023-01-01")],
        "key string, value string, fetched_at int, expires_at string",
    ).withColumn("expires_at", F.col("expires_at").cast("timestamp"))
    assert rows(fill.last_good(requests, snaps, "2024-01-01"), "key", "value") == [("a", "new"), ("b", "mid"), ("c", ""), ("d", "")]


# ------------------------------------------------------------------ quality


def record(**changes):
    base = {
        "id": "i", "content": "c", "summary": "s" * 150, "questions": ["q"], "answers": ["a"], "relations": [],
        "content_embedding": [1.0], "summary_embedding": [1.0],
    }
    return Row(**{**base, **changes})


DDL = (
    "id string, content string, summary string, questions array<string>, answers array<string>, relations array<string>, "
    "content_embedding array<double>, summary_embedding array<double>"
)


def test_validation_rules(spark):
    cases = [
        record(), record(id="content", content=""), record(id="summary", summary="short"), record(id="nosummary", summary=None),
        record(id="q", questions=[]), record(id="a", answers=None), record(id="rel", relations=None),
        record(id="nan", content_embedding=[1.0, math.nan]), record(id="inf", summary_embedding=[-math.inf]),
        record(id="noemb", content_embedding=None, summary_embedding=[]),
    ]
    df = spark.createDataFrame(cases, DDL)
    valid, rejected = quality.validate_semantics(df)
    assert {r["id"] for r in rejected.collect()} == {"content", "nosummary", "q", "a", "nan", "inf"}
    assert valid.count() == 4
    saved, bad = quality.validate_for_save(df)
    assert {r["id"]: r["reasons"] for r in bad.collect()} == {
        "summary": ["summary"], "nosummary": ["summary"], "q": ["questions"], "a": ["answers"], "rel": ["relations"],
        "nan": ["content_embedding"], "inf": ["summary_embedding"],
    }
    assert {r["id"] for r in saved.collect()} == {"i", "content", "noemb"}


def test_filter_records(spark):
    data = [("1", "en", "A", "2024-01-01 00:00:00"), ("2", "en", "B", "2024-01-02 00:00:00"), ("3", "pt", "A", "2024-01-02 00:00:01"), ("4", "pt", None, None)]
    df = spark.createDataFrame(data, "id string, language string, category string, created_at string").withColumn(
        "created_at", F.col("created_at").cast("timestamp")
    )
    ids = lambda **k: {r["id"] for r in quality.filter_records(df, **k).collect()}
    assert ids() == {"1", "2", "3", "4"}
    assert ids(langs=[], categories=None) == {"1", "2", "3", "4"}
    assert ids(langs=["en"], categories=["A"]) == {"1"}
    assert ids(start="2024-01-02") == {"2", "3"}
    assert ids(start="2024-01-01T00:00:00", end="2024-01-02") == {"1", "2"}


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame([("1", "en", "A", "x")], "id string, language string, category string, content string").withColumn(
        "created_at", F.lit("2024-01-01").cast("timestamp")
    ).write.parquet(path)
    plan = quality.filter_records(spark.read.parquet(path), ["en"], ["A"], "2024-01-01").select("id")._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "EqualTo(language,en)" in plan.replace("In(language, [en])", "EqualTo(language,en)")
    assert "content:string" not in plan.split("ReadSchema")[-1]


# ------------------------------------------------------------------ categories


def test_categories(spark):
    df = spark.createDataFrame([("programacao",), ("PROGRAMAÇÃO",), ("devops",), ("x",)], "name string")
    assert [r[0] for r in df.select(C.normalize_category(F.col("name"))).collect()] == ["Programação", "Programação", "DevOps", None]
    known = spark.createDataFrame([("Found",)], "name string")
    names = spark.createDataFrame([("Found",), ("Blockchan",), ("zzzzzzzzzzzzzzzzzzzz",)], "name string")
    assert rows(C.resolve_categories(names, known, 3), "name")[0] == ("Blockchan",)
    got = {r["name"]: r["resolved"] for r in C.resolve_categories(names, known, 3).collect()}
    assert got == {"Found": "Found", "Blockchan": "Blockchain", "zzzzzzzzzzzzzzzzzzzz": None}
    jobs = spark.createDataFrame([(["en"], None, "json"), (None, ["programacao"], "csv")], "lang array<string>, category array<string>, format string")
    grid = rows(C.work_grid(jobs, ["en", "pt"], ["DevOps", "x"]), "format", "lang", "category", "weight")
    assert grid == [("csv", "en", "Programação", 1.0), ("csv", "pt", "Programação", 1.0), ("json", "en", "DevOps", 1.0), ("json", "en", "x", 1.0)]


# ------------------------------------------------------------------ walks

LINKS = "src string, pos int, url string, dst string"


def crawl(spark, graph, start, depth=1, visited=(), cap=1000):
    data = [(s, i, f"/wiki/{d}", d) for s, ds in graph.items() for i, d in enumerate(ds)]
    starts = spark.createDataFrame([(start,)], "start string")
    out = walks.crawl_links(spark.createDataFrame(data, LINKS), starts, depth, visited, cap)
    return [(r["title"], r["depth"]) for r in out.orderBy("depth", "path", "pos").collect()]


def literal_crawl(graph, start, depth, visited, cap):
    seen, queue, out = set(visited), deque([(start, 0)]), []
    while queue and len(out) < cap:
        page, level = queue.popleft()
        if page in seen:
            continue
        seen.add(page)
        for target in graph.get(page, []):
            if len(out) >= cap:
                break
            if target in seen:
                continue
            out.append((target, level))
            if level < depth:
                queue.append((target, level + 1))
    return out


def test_crawl_literal_cases(spark):
    graph = {"Start": ["P1", "P2"], "P1": ["P3"], "P2": ["P4"]}
    assert crawl(spark, graph, "Start") == [("P1", 0), ("P2", 0), ("P3", 1), ("P4", 1)]
    assert crawl(spark, {"Start": ["A", "B"], "A": ["C"]}, "Start", visited=["A"]) == [("B", 0)]
    assert crawl(spark, {"A": ["B", "C", "D"]}, "A", cap=2) == [("B", 0), ("C", 0)]
    assert crawl(spark, graph, "Start", visited=["Start"]) == []


@pytest.mark.parametrize("seed", range(5))
def test_crawl_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(9)]
    graph = {n: [rng.choice(names) for _ in range(rng.randint(0, 4))] for n in names}
    depth, cap, visited = seed % 4, rng.choice([3, 8, 1000]), rng.sample(names[1:], seed % 3)
    assert crawl(spark, graph, "n0", depth, visited, cap) == literal_crawl(graph, "n0", depth, visited, cap)


def test_category_members(spark):
    data = [
        ("Root", "Page A", 0, "ua", 0), ("Root", "Category:Sub", 14, "us", 1), ("Root", "Page B", 0, "ub", 2),
        ("Sub", "Page C", 0, "uc", 0), ("Sub", "Page A", 0, "ua", 1), ("Sub", "Categoria:Deep", 14, "ud", 2),
        ("Deep", "Page D", 0, "ux", 0), ("Deep", "Category:Root", 14, "ur", 1), ("Deep", "File:x", 6, "uf", 2),
    ]
    df = spark.createDataFrame(data, "parent string, member string, ns int, url string, pos int")
    roots = spark.createDataFrame([("Root",)], "root string")
    got = rows(walks.category_members(df, roots), "title", "category", "depth")
    assert got == [("Page A", "Root", 0), ("Page B", "Root", 0), ("Page C", "Sub", 1), ("Page D", "Deep", 2)]
    assert rows(walks.category_members(df, roots, max_depth=1), "title") == [("Page A",), ("Page B",), ("Page C",)]
    capped = walks.category_members(df, roots, cap=3)
    assert rows(capped, "title") == [("Page A",), ("Page C",), ("Page D",)]


# ------------------------------------------------------------------ stats, order, entities


def test_progress_empty_and_full(spark):
    ddl = "cluster int, topic string, language string"
    empty = stats.progress(spark.createDataFrame([], ddl)).first()
    assert (empty["pages_processed"], empty["clusters"], empty["duplicates_removed"]) == (0, [], 0)
    df = spark.createDataFrame([(2, "b", "en"), (0, "", "pt"), (2, None, "en")], ddl)
    row = stats.progress(df, F.lit(4), F.lit(5)).first()
    assert row.asDict() == {
        "pages_processed": 3, "clusters": [0, 2], "topics": ["b"], "languages": ["en", "pt"], "duplicates_removed": 4, "invalid_records": 5,
    }


def test_relation_graph(spark):
    data = [(0, "Ada", "worked at", "IBM"), (1, "Bob", "studied at", "MIT"), (2, "Ada", "discovered", "IBM")]
    df = spark.createDataFrame(data, "seq int, subject string, relation string, object string")
    nodes, edges = stats.relation_graph(df)
    assert rows(nodes, "id") == [("Ada",), ("Bob",), ("IBM",), ("MIT",)]
    assert rows(edges, "src", "dst", "relation") == [("Ada", "IBM", "discovered"), ("Bob", "MIT", "studied at")]


def test_hit_rate_without_lookups(spark):
    df = spark.createDataFrame([("a", 0, 0), ("b", 1, 0), ("b", 0, 1)], "k string, h int, m int")
    assert rows(stats.hit_rate(df, F.col("h") == 1, F.col("m") == 1, "k"), "k", "hit_rate") == [("a", 0.0), ("b", 0.5)]


def test_numbered_and_manifest(spark):
    df = spark.createDataFrame(
        [(7, "http://x/img.jpg", "cap", "t"), (200000, None, "c", "t"), (300000, "http://x/pic", "", "title"), (300001, "http://x/a.tar.gz", None, None)],
        "seq bigint, image_url string, caption string, title string",
    )
    assert rows(ordering.image_manifest(df), "file_name", "caption") == [("00000.jpg", "cap"), ("00002.jpg", "title"), ("00003.gz", "")]
    assert rows(ordering.numbered(df, "seq", "n", bucket_bits=2), "seq", "n") == [(7, 0), (200000, 1), (300000, 2), (300001, 3)]


def test_positions_of_a_sparse_order(spark):
    df = spark.range(500).select(F.xxhash64("id").alias("h"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 3).alias("k"))
    order = sorted(r["h"] for r in df.collect())
    assert rows(ordering.numbered_by_range(df, "h", "n"), "h", "n") == [(h, i) for i, h in enumerate(order)]
    got = ordering.numbered_by_range(df, "h", "n", ["k"])
    assert got.columns == ["h", "k", "n"]
    groups = {}
    for r in sorted(df.collect()):
        groups.setdefault(r["k"], []).append(r["h"])
    expected = {(k, h, i) for k, hashes in groups.items() for i, h in enumerate(hashes)}
    assert {(r["k"], r["h"], r["n"]) for r in got.collect()} == expected


def test_entities(spark):
    docs = spark.createDataFrame([(0, "Ana lives in New York, near York.")], "seq int, content string")
    names = spark.createDataFrame([("New York", "LOC"), ("York", "LOC"), ("Ana", "PERSON")], "name string, type string")
    assert rows(find_entities(docs, names), "pos", "text") == [(0, "Ana"), (3, "New York"), (4, "York"), (6, "York")]


# ------------------------------------------------------------------ summaries, clusters


def test_summary(spark):
    docs = spark.createDataFrame(
        [(0, "The cat. The cat. Rare zebra words! The cat? Unique quokka."), (1, "The cat."), (2, "..."), (3, "")], "seq int, content string"
    )
    got = {r["seq"]: r["summary"] for r in summarize(docs).collect()}
    assert got[0].endswith("Rare zebra words Unique quokka") and got[1] == "The cat"
    assert got[2] == "..." and got[3] == ""


def test_clusters(spark):
    data = [(i, [1.0, 0.01 * i] if i % 2 else [0.01 * i, 1.0]) for i in range(20)] + [(20, [0.0, 0.0])]
    df = spark.createDataFrame(data, "seq int, content_embedding array<float>")
    got = {r["seq"]: r["cluster"] for r in vectors.cluster_vectors(df, k=2).collect()}
    assert len({got[i] for i in range(1, 20, 2)}) == 1 and len({got[i] for i in range(0, 20, 2)}) == 1 and got[0] != got[1]
    assert {r["cluster"] for r in vectors.cluster_vectors(df.limit(3), k=10).collect()} == {0}


def test_text_embeddings(spark):
    df = spark.createDataFrame([(0, "a b c"), (1, "c d"), (2, "")], "seq int, content string")
    got = {r["seq"]: r for r in vectors.embed_texts(df).collect()}
    assert got[0]["content_embedding_terms"] == ["a", "b", "c"] and got[2]["content_embedding"] == [] == got[2]["content_embedding_terms"]
    assert abs(sum(x * x for x in got[1]["content_embedding"]) - 1) < 1e-6
    rare, common = math.log(4 / 2), math.log(4 / 3)
    assert got[1]["content_embedding"] == pytest.approx([common / math.hypot(rare, common), rare / math.hypot(rare, common)])


def test_entities_of_many_words_and_marks(spark):
    docs = spark.createDataFrame([(0, "From St. John's to the United States of America"), (1, None)], "seq int, content string")
    names = spark.createDataFrame(
        [("St. John's", "LOC"), ("United States of America", "LOC"), ("...", "MARK"), (None, "NONE")], "name string, type string"
    )
    assert rows(find_entities(docs, names), "pos", "text") == [(1, "St. John's"), (6, "United States of America")]
    assert rows(find_entities(docs, names, 3), "pos", "text") == [(1, "St. John's")]
    assert rows(find_entities(docs, names.limit(0)), "pos", "text") == []
