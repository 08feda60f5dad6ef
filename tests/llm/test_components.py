import random

import numpy as np

from corpusmill.llm import components, sketch_join
from corpusmill.llm.components import connected, stars
from tests.llm.test_sketch_join import brute, got, near_copies


def plain(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {x: find(x) for x in root}


def graphs():
    rng = random.Random(3)
    names = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(600)]
    yield []
    yield [(5, 5)]
    yield [(names[i], names[i + 1]) for i in range(300)]
    yield [(names[0], x) for x in names[1:300]] + [(x, names[0]) for x in names[1:50]]
    yield [(rng.choice(names), rng.choice(names)) for _ in range(400)] + [(names[1], names[2])] * 3
    yield [(i, i + 1) for i in range(200)] + [(1_000 - i, 999 - i) for i in range(200)]


def jobs(spark, run):
    spark.sparkContext.setJobGroup(name := f"jobs{random.random()}", "")
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_stars():
    for links in graphs():
        u, v = np.array(links, np.int64).reshape(-1, 2).T
        a, b = stars(u, v)
        want = {x: r for x, r in plain(links).items() if x != r}
        assert dict(zip(a.tolist(), b.tolist())) == want and len(a) == len(want) <= len(links)


def test_graphs(spark, monkeypatch):
    for fold in (components.FOLD_LINKS, 3):
        monkeypatch.setattr(components, "FOLD_LINKS", fold)
        for links in graphs():
            edges = spark.createDataFrame(links, "a long, b long").repartition(5)
            rows = [(r["node"], r["root"]) for r in connected(edges, "a", "b").collect()]
            assert len(rows) == len(dict(rows)) and dict(rows) == plain(links)


def test_stars_need_no_round(spark, monkeypatch):
    written = []
    keep = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: written.append(name) or keep(df, name))
    edges = spark.createDataFrame([(i, 0) for i in range(1, 100)], "a long, b long").repartition(4)
    assert connected(edges, "a", "b").filter("root <> 0").count() == 0
    assert len(written) == 2


def test_bitmap_counts_once(spark):
    table = spark.range(5_000).repartition(2)
    bits, n = jobs(spark, lambda: sketch_join.bitmap(table, "id", 5_000))
    assert sketch_join.may_hold(bits, np.arange(5_000)).all() and not sketch_join.may_hold(bits, np.array([1 << 18 | 1 << 17])).any()
    assert n <= 3


def test_jobs_of_the_join(spark):
    """What the driver holds grows with the jobs and exchanges that run after one another."""
    rows = list(enumerate(near_copies(3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found, n = jobs(spark, lambda: got(sketch_join.near_duplicates(docs)))
    assert found == brute(rows)
    assert n <= 200
