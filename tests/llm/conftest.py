"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats, clashing columns."""

import random

import pytest

SF = "/root/testdata/sf0.001"


def awkward_texts():
    rng = random.Random(5)
    words = [rng.choice("alpha beta gamma delta épée straße 日本 the of and".split()) + str(rng.randrange(50)) for _ in range(30_000)]
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    return [
        None, "", " ", "\n\n\t", "word", "two words", base, base, base + " seventeen", base.upper(), " ".join(words),
        "a" * 50_000, "1" * 40_000, "x@" * 5_000, "é" * 300 + "\u00a0" + "z", "\u0000\u0001 odd \u200b chars \U0001f600 end",
        "<|endoftext|> a<|startoftext|>b", "\\b \\l </turn> <turn role=\"x\">", "((((" * 500 + "+1" + "(" * 3_000,
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents of awkward texts with extra columns whose names operators may use inside."""
    rows = [(i, t, f"src{i % 2}" if i % 5 else None, i, "x", [1], {"a": 1}) for i, t in enumerate(awkward_texts())]
    rows += [(3, "repeated id", "src0", 1, "y", None, None), (None, "null id words here", "src1", 1, "y", [], {}), rows[6]]
    schema = "doc_id long, text string, source string, n long, class string, spans array<int>, kept map<string,int>"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def all_texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def run_query(spark):
    def run(name, key="doc_id", sf=SF):
        from corpusmill.llm.queries import QUERIES

        return {r[key]: r.asDict() for r in QUERIES[name](spark, sf).collect()}

    return run
