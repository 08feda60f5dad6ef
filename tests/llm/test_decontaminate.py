import random
import re
from hashlib import sha256

from pyspark.sql import functions as F

from corpusmill.llm import decontaminate as dc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=13):
    words = words_of(text)
    at = {}
    for size in {min(window, len(words_of(t))) for _, t in items} - {0}:
        for i in range(len(words) - size + 1):
            at.setdefault(tuple(words[i : i + size]), []).append(i)
    hit, found = set(), set()
    for key, item in items:
        own = words_of(item)
        size = min(window, len(own))
        for i in range(len(own) - size + 1) if own else ():
            for start in at.get(tuple(own[i : i + size]), ()):
                hit |= set(range(start, start + size))
                found.add(key)
    found = sorted(str(k) for k in found if k is not None)
    return len(words), len(hit), found


def test_documents(spark, run_query, all_texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for key, r in run_query("op9_decontamination").items():
        n, hit, found = brute(all_texts[key], items)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(found)), key
        assert r["items_sha256"] == sha256(",".join(found).encode()).hexdigest()
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def made_items():
    rng = random.Random(2)
    w = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    items = [(i, w(rng.randrange(1, 30))) for i in range(25)] + [(None, w(14)), (3, w(20)), (90, None), (91, "..."), (92, "a a a"), (93, "Zeta! zeta?")]
    return items, [w(rng.randrange(0, 120)) for _ in range(60)] + [items[4][1].upper() + "! " + items[7][1], "zeta, ZETA", None, "", "x " * 3_000 + items[5][1]]


def test_small_alphabet(spark):
    """Few words, so that matches overlap, nest and cross items; also with several blocks of items."""
    items, texts = made_items()
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    for block_words in (dc.BLOCK_WORDS, 60):
        found = dc.find_contamination(docs, table, window=6, block_words=block_words).withColumn("n_hit", dc.n_hit())
        for r in found.collect():
            want = brute(r["text"], items, 6)
            assert (r["n_words"], r["n_hit"], sorted(r["hit_items"])) == want, (block_words, r["doc_id"])


def test_awkward(spark, awkward):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id long, text string")
    out = dc.find_contamination(awkward, items)
    assert out.count() == awkward.count()
    assert {r["hit_items"][0] for r in out.filter("size(hit_items) > 0").collect()} == {"1"}
    assert dc.find_contamination(awkward, items.filter("false")).filter("size(hit_items) > 0").count() == 0
    assert dc.find_contamination(awkward.filter("false"), items).count() == 0


def test_cut(spark):
    item = " ".join(f"i{k}" for k in range(20))
    items = spark.createDataFrame([(1, item), (2, "short one")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Before, ({item})! after"), (2, "a short one b"), (3, None), (4, item)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in dc.cut_spans(dc.find_contamination(docs, items)).collect()}
    assert out == {1: "Before, ( )! after", 2: "a short one b", 3: None, 4: ""}


def test_one_step_drops_and_cuts_like_three(spark):
    from pyspark.sql import functions as F

    from corpusmill.llm import decontaminate as D

    words = " ".join(f"item{i}" for i in range(20))
    items = spark.createDataFrame([("a", words), ("b", " ".join(f"other{i}" for i in range(15))), ("c", "one two")], "item_id string, text string")
    filler = " ".join(f"w{i}" for i in range(600))
    rows = [(1, f"{filler} {words} {filler}"), (2, words), (3, filler), (4, None), (5, ""), (6, f"{filler} one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block_words in (100_000, 10):
        found = D.find_contamination(docs, items, block_words=block_words)
        clean = found.filter(~D.is_contaminated(D.n_hit(), F.col("n_words")))
        want = {tuple(r) for r in D.cut_spans(clean).select(*docs.columns).collect()}
        got = D.drop_contaminated(docs, items, block_words=block_words)
        assert got.columns == docs.columns and {tuple(r) for r in got.collect()} == want
        assert {r[0] for r in want} == {1, 3, 4, 5, 6} and f"{filler} {filler}" in {r[1] for r in want}
