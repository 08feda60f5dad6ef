"""Collocations against brute force, also where fingerprints collide and bits are shared."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import phrases
from corpusmill.llm.phrases import Words, mine_collocations, phrase_counts

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD = str.maketrans(UPPER, UPPER.lower())


def brute(rows, least=30, longest=4, share=80, top=2000):
    counts, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    frequent = {key: a for key, a in counts.items() if a >= least}
    out = {}
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        cuts = [(2_000_000 * a // (frequent[lang, words[:k]] + frequent[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        covered = any(
            m == lang and len(longer) > len(words) and 100 * b >= share * a and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (m, longer), b in frequent.items()
        )
        if not covered:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), frequent[lang, words[:k]], frequent[lang, words[k:]]))
    return {
        (lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    }


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = mine_collocations(df, **more).drop("first_doc").collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


def invented(seed, n=60):
    rng = random.Random(seed)
    words = [a + b for a in "ka lo Mi ru té".split() for b in "n s".split()]
    out = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " - ", "!"]) for _ in range(rng.randrange(150)))
        if i % 3 == 0:
            text += " in the Open sea of salt " * 2
        out.append((i, text, rng.choice(["en", "en", "fr", None, "", "und"])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = invented(seed)
    expected = brute(rows, least=12)
    assert len(expected) > 40
    assert mined(spark, rows, least=12) == expected


def test_other_parameters(spark):
    rows = invented(3)
    assert mined(spark, rows, least=5, longest=3, share=40, top=7) == brute(rows, 5, 3, 40, 7)
    assert mined(spark, rows, least=8, longest=2) == brute(rows, 8, 2)


def test_a_bitmap_with_shared_bits_loses_nothing(spark):
    rows = invented(4)
    assert mined(spark, rows, least=9, bits=15) == brute(rows, 9)


def test_colliding_fingerprints_change_nothing(spark, monkeypatch):
    def weak(raw, starts, ends, fold=True):
        # Words that share their first byte and length collide.
        return raw[starts].astype(np.uint64) * np.uint64(257) + (ends - starts).astype(np.uint64) if len(starts) else np.zeros(0, np.uint64)

    monkeypatch.setattr(phrases, "hash_spans", weak)
    rows = invented(5)
    assert mined(spark, rows, least=12) == brute(rows, 12)


@pytest.mark.parametrize("least", [1, 30, 255, 256, 70_000])
def test_packed_counts_add_up(least):
    rng = np.random.default_rng(least)
    total, packed = Counter(), []
    for _ in range(6):
        found = np.unique(rng.integers(0, 1 << 32, 300).astype(np.uint64) >> np.uint64(24) << np.uint64(20) | np.uint64(3))
        found = np.unique(np.concatenate((found, np.array([0, 65_536, (1 << 32) - 1], np.uint64))))
        n = rng.integers(1, 2 * least + 2, len(found))
        total.update(dict(zip(found.tolist(), n.tolist())))
        packed.append(phrases._pack(found, n, least))
    table = pa.Table.from_batches(packed).sort_by("bucket")
    got = [fp for out in phrases._add_up(least)(iter(table.to_batches(max_chunksize=7))) for fp in out.column(0).to_pylist()]
    assert got == sorted(fp for fp, n in total.items() if n >= least)
    assert list(phrases._add_up(least)(iter([]))) == []


def test_numbers_follow_the_bytes(monkeypatch):
    monkeypatch.setattr(phrases, "hash_spans", lambda raw, starts, ends, fold=True: np.zeros(len(starts), np.uint64))
    raw = np.frombuffer(b"aa bb aa b bb cc", np.uint8)
    number, first = Words(raw, np.array([0, len(raw)]), np.zeros(1, np.uint64)).exact_numbers()
    assert len(set(number)) == 4 and number[0] == number[2] and number[1] == number[4] and [int(first[k]) for k in number] == [0, 1, 0, 3, 1, 5]


def test_equal_grams_have_equal_fingerprints():
    raw = np.frombuffer(b"x one two three y one two three", np.uint8)
    words = Words(raw, np.array([0, len(raw)]), np.zeros(1, np.uint64))
    for size in (1, 2, 3):
        f = words.fingerprints(size)
        assert f[1] == f[5] and len(set(f)) == len({tuple(b"x one two three y one two three".split()[i : i + size]) for i in range(len(f))})


def test_first_document_and_totals(spark):
    rows = [(9, "a b", "en"), (4, "a b. a b", "en"), (None, "a b", "en"), (2, "b a", "en"), (1, "a b", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {(r["lang"], r["phrase"]): (r["a"], r["first_doc"]) for r in phrase_counts(df, least=2).collect()}
    assert got == {("en", "a b"): (4, 4), ("en", "a"): (5, 2), ("en", "b"): (5, 2), ("en", ""): (10, 2), ("fr", ""): (2, 1)}


def test_awkward_rows(spark, awkward):
    df = awkward.withColumnRenamed("class", "size")
    got = mine_collocations(df, lang_col="source", least=3).drop("first_doc").collect()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    assert {tuple(r) for r in got} == brute(rows, 3)
    assert mine_collocations(df.limit(0), lang_col="source").collect() == []
    bare = spark.createDataFrame([(1, None, None), (2, "", None), (3, " . , ", "en")], "doc_id int, text string, lang string")
    assert mine_collocations(bare, least=1).collect() == []


def test_exact_scores_beyond_64_bits(spark):
    from corpusmill.llm.phrases import weakest_cuts

    big = 9 * 10**18
    rows = [("en", 1, "a", big, 0), ("en", 1, "b", big - 1, 0), ("en", 2, "a b", big - 2, 0)]
    got = weakest_cuts(spark.createDataFrame(rows, "lang string, size int, phrase string, a long, first_doc long")).first()
    assert got["score"] == 2_000_000 * (big - 2) // (2 * big - 1)
