import re
from collections import Counter

from pyspark.sql import functions as F

from corpusmill.llm import line_frequency as lf

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {t for t, n in Counter(triples).items() if n > 1}
    hit = {i + k for i, t in enumerate(triples) if t in often for k in range(3)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n,
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_on_documents(run_query, all_texts):
    got = run_query("op1_line_frequency")
    assert len(got) == len(all_texts)
    for key, text in all_texts.items():
        assert tuple(got[key][n] for n in NAMES) == brute(text), key
        assert not (got[key]["base_failed"] and got[key]["kept"])


def test_base_on_awkward(awkward):
    rows = lf.base_columns(awkward.select("doc_id", "text")).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert tuple(r[n] for n in NAMES) == brute(r["text"]), r["doc_id"]


def test_verdicts_on_awkward(awkward):
    rows = lf.quality_verdicts(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r["kept"] is not None for r in rows)
    assert lf.quality_verdicts(awkward.filter("false")).count() == 0


def test_frequent_lines(spark):
    own = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{own} d{i}\nShared   LINE {i}", "h") for i in range(6)]
    rows += [(10 + i, f"{' '.join('c%d' % k for k in range(60))}\nx", "h") for i in range(6)]
    rows += [(20, f"{own} other\nshared line 9", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in lf.quality_verdicts(docs, max_documents=4).collect()}
    # Digits do not tell lines apart, so both lines of the first group are frequent; the first document keeps them.
    assert out[0]["kept"] and not out[1]["kept"] and not out[5]["kept"]
    assert out[10]["kept"] and not out[11]["kept"]
    assert out[20]["kept"] and out[20]["lost_chars"] == 0
    texts = {r["doc_id"]: r["text"] for r in lf.remove_frequent_lines(docs.withColumn("__x", F.lit(1)), max_documents=4).collect()}
    assert texts[0] == rows[0][1] and texts[3] == "" and texts[20] == rows[-1][1]
