import os
import random
import re
from collections import Counter, defaultdict

import numpy as np

from corpusmill.llm import sketch_join as sj

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = defaultdict(list)
    for i, own in enumerate(sets):
        common = Counter(o for s in own for o in held[s])
        for s in own:
            held[s].append(i)
        for o, n in common.items():
            if 100 * n >= 80 * (len(own) + len(sets[o]) - n):
                root[find(i)] = find(o)
    low = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)].append(key)
    return sorted(((key, len(sets[i]), key if not sets[i] else min(low[find(i)], default=None)) for i, (key, _) in enumerate(rows)), key=str)


def got(frame):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect()), key=str)


def near_copies(seed=1):
    """Chains and clusters of edits around the threshold, over several sizes and band borders."""
    rng = random.Random(seed)
    texts = []
    for size in (3, 6, 9, 13, 20, 33, 64, 70, 130, 260, 500):
        words = [f"w{rng.randrange(10_000)}" for _ in range(size)]
        for k in range(8):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(0, max(2, size // 30))):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10_000)}"
            if k % 3 == 0:
                words += [f"t{rng.randrange(10_000)}" for _ in range(rng.randrange(0, max(2, size // 7)))]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"q{rng.randrange(10_000)}" for _ in range(rng.randrange(10, 60))) for _ in range(60)]
    return texts


def test_awkward(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert got(sj.near_duplicates(awkward)) == brute(rows)


def test_edited_copies(spark):
    rows = list(enumerate(near_copies()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert got(sj.near_duplicates(docs)) == want
    left = sj.drop_near_duplicates(docs)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({c for _, _, c in want})


def test_documents(run_query, all_texts):
    result = run_query("op4_ngram_jaccard")
    assert sorted(((k, r["n_shingles"], r["component_id"]) for k, r in result.items()), key=str) == brute(sorted(all_texts.items()))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sj.near_duplicates(docs).count() == 0 and sj.drop_near_duplicates(docs).count() == 0


def test_similar_sets_share_a_block():
    """The guarantee itself: sets that differ by as much as allowed share a key, at every size."""
    rng = np.random.RandomState(0)
    for size in [*range(1, 70), 100, 127, 128, 129, 255, 256, 400, 1023, 1024]:
        for _ in range(6):
            a = rng.randint(0, 1 << 62, size).astype(np.uint64)
            room = [(x, y) for x in range(size // 5 + 1) for y in range(size // 3 + 1) if 100 * (size - x) >= 80 * (size + y)]
            x, y = room[rng.randint(len(room))] if rng.rand() < 0.5 else max(room, key=sum)
            b = np.concatenate([a[x:], rng.randint(0, 1 << 62, y).astype(np.uint64)])
            values = np.concatenate([np.sort(a), np.sort(b)])
            keys, owner = sj.block_keys(values, np.repeat([0, 1], [len(a), len(b)]), 2)
            assert set(keys[owner == 0]) & set(keys[owner == 1]), (size, x, y)
            hamming = np.bitwise_count(np.bitwise_xor(*sj.parity_sketch(values, np.repeat([0, 1], [len(a), len(b)]), 2))).sum()
            assert hamming <= x + y


def test_large_buckets_in_units(spark, monkeypatch):
    monkeypatch.setattr(sj, "COMPARE", 4)
    monkeypatch.setattr(sj, "VERIFY", 3)
    monkeypatch.setattr(sj, "BUCKET_KEYS", 50)
    rows = list(enumerate(near_copies(7)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sj.near_duplicates(docs)) == brute(rows)


def test_members_of_a_hot_key_are_spread(spark, monkeypatch):
    base = " ".join(f"w{k}" for k in range(200))
    docs = spark.createDataFrame([(i, f"{base} end{i} tail{i}") for i in range(240)], "doc_id long, text string").repartition(8)
    rows = sj.bucket_rows(docs, "text", 5, sj.SIMILARITY, 1).persist()
    left = rows.filter("kind = 1").count()
    sizes = []
    apply = type(rows.groupBy("bucket")).applyInArrow

    def spy(self, function, schema):
        sizes.append(self.count().collect())
        return apply(self, function, schema)

    monkeypatch.setattr(type(rows.groupBy("bucket")), "applyInArrow", spy)
    got = sorted(map(tuple, sj.tie_rows(rows).collect()))
    monkeypatch.undo()
    assert left >= 8 and sum(r["apart"] != 0 for r in sizes[0]) == left
    whole = rows.groupBy("bucket").applyInArrow(sj._ties, "key long, member long, hub long")
    assert got == sorted(map(tuple, whole.collect()))


def test_similar_sets_share_as_many_keys_as_asked():
    rng = np.random.RandomState(1)
    for similarity in (sj.SIMILARITY, (90, 100)):
        part, whole = similarity
        for size in [*range(1, 40), 63, 64, 65, 79, 102, 127, 128, 129, 300, 511, 512, 640, 1023, 1024, 1279, 1500]:
            for _ in range(6):
                most = size * (whole - part) // whole
                x, y = [(most, 0), (0, size * (whole - part) // part), (rng.randint(most + 1), 0)][rng.randint(3)]
                a = rng.randint(0, 1 << 62, size).astype(np.uint64)
                b = np.concatenate([a[x:], rng.randint(0, 1 << 62, y).astype(np.uint64)])
                values = np.concatenate([np.sort(a), np.sort(b)])
                keys, owner = sj.block_keys(values, np.repeat([0, 1], [len(a), len(b)]), 2, similarity)
                shared = len(set(keys[owner == 0]) & set(keys[owner == 1]))
                assert shared >= sj.least_shared(np.array([len(a), len(b)]), similarity).max(), (similarity, size, x, y)


def test_long_texts_with_a_common_passage(spark, monkeypatch):
    """They share a few blocks only, so they make no pairs with each other and their sets are not written."""
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"q{rng.randrange(100_000)}" for _ in range(1_500)) + f" {passage}") for i in range(60)]
    rows += [(100 + i, f"{t} more{i}") for i, t in rows[:5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    written = defaultdict(list)
    keep = sj.materialize
    monkeypatch.setattr(sj, "materialize", lambda df, name: written[name].append(out := keep(df, name)) or out)
    assert got(sj.near_duplicates(docs)) == brute(rows)
    assert sum(t.count() for t in written["crossing_pairs"]) <= 20
    files = [f.removeprefix("file://") for tables in written.values() for t in tables for f in t.inputFiles()]
    assert sum(os.path.getsize(f) for f in files) < sum(len(t) for _, t in rows) / 2
