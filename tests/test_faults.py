"""Inputs that once lost data: non-finite vectors, unmarked links, texts that start with a brace."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.similarity import deduplicate_by_embedding
from corpusmill.operators.vectors import cluster_vectors
from corpusmill.operators.walks import crawl_links
from corpusmill.sources.tables import QUESTION, _struct_or_text


@pytest.mark.parametrize("at", [0, 7, 19])
def test_non_finite_vectors_are_kept_and_remove_nobody(spark, at):
    rows = [(i, [float(i == k) for k in range(20)]) for i in range(20)]
    rows[at] = (at, [float("nan")] + [1.0] * 19)
    rows += [(20, [float("inf")] * 20), (21, None), (22, [1.0, None] + [0.0] * 18), (23, rows[(at + 1) % 20][1])]
    records = spark.createDataFrame(rows, "seq long, content_embedding array<float>")
    for pivots in (1, 5):
        kept, removed = deduplicate_by_embedding(records, 0.9, pivots=pivots)
        assert [r["seq"] for r in removed.collect()] == [23]
        assert kept.count() == len(rows) - 1


def test_clusters_of_unusable_vectors_are_null(spark):
    rows = [(i, [float(i % 2), float(1 - i % 2)]) for i in range(30)] + [(30, None), (31, [float("nan"), 1.0]), (32, [0.0, 0.0])]
    records = spark.createDataFrame(rows, "seq long, content_embedding array<float>")
    got = {r["seq"]: r["cluster"] for r in cluster_vectors(records, k=2).collect()}
    assert len(got) == 33 and got[0] == got[2] != got[1]
    assert got[30] is None and got[31] is None and got[32] is None


def test_links_without_target(spark):
    links = spark.createDataFrame([("a", 0, "u", "b"), ("a", 1, "v", None)], "src string, pos int, url string, dst string")
    starts = spark.createDataFrame([("a",)], "start string")
    for visited in ((), ("z",)):
        assert [r["title"] for r in crawl_links(links, starts, visited=visited).collect()] == ["b"]


def test_text_that_starts_with_a_brace(spark):
    rows = spark.createDataFrame([("{not json",), ('{"text": "q"}',), ("plain",)], "q string")
    got = [r["t"] for r in rows.select(_struct_or_text(F.col("q"), QUESTION)["text"].alias("t")).collect()]
    assert got == ["{not json", "q", "plain"]


def test_null_fields_stay_in_json(spark):
    from corpusmill.sinks.writers import json_rows

    assert json_rows(spark.createDataFrame([("1", None)], "id string, title string")).first()["data"] == '{"id":"1","title":null}'


def test_missing_metadata_stays_missing(spark):
    from corpusmill.operators.fill import attach_metadata, complete_missing_fields

    records = spark.createDataFrame([("a", "en", None), ("b", "en", None)], "title string, language string, metadata struct<x:int>")
    extra = spark.createDataFrame([("b", "en", (7,), 0)], "title string, language string, metadata struct<x:int>, extra_seq int")
    got = {r["title"]: r["metadata"] for r in complete_missing_fields(records, extra).collect()}
    assert got["a"] is None and got["b"]["x"] == 7
    given = spark.createDataFrame([("a", "Q1", None), ("a", "Q2", "u")], "title string, wikidata_id string, image_url string")
    got = {r["title"]: (r["wikidata_id"], r["image_url"]) for r in attach_metadata(records, given, "title").collect()}
    assert got == {"a": ("Q2", "u"), "b": (None, None)}
