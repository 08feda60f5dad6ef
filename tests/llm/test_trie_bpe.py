import random
import sys
import tracemalloc
from hashlib import sha256

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusmill.llm import trie_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(rows, texts, library):
    assert len(rows) == len(texts)
    by = {}
    for key, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        by.setdefault(key, []).append((len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()))
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) in by[r["doc_id"]], r["doc_id"]


def test_documents(run_query, all_texts, library):
    check(list(run_query("op7_bpe").values()), list(all_texts.items()), library)


def test_awkward(awkward, library):
    rows = trie_bpe.token_digests(awkward, PATH).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in awkward.collect()], library)
    assert trie_bpe.token_digests(awkward.filter("false"), PATH).count() == 0


def test_words_and_cache(all_texts, library, monkeypatch):
    """Every distinct word, and the same with a cache that overflows all the time."""
    words = sorted({w for t in all_texts.values() for w in (t or "").split()})
    odd = ["don't", "I'LL", "it's''s", "x1y22", "ÅÄÖ", "Σ\u0301Σ", "ı", "\u0130stanbul", "a\u0301\u0327", "ﬁ", "!!!???", "\u00adsoft", "\u3000wide", "👩\u200d👩", "\u0301x", "<|endoftext|><|endoftext|>", "<|x|>", "aaaa" * 300]
    texts = words + odd + [" ".join(odd)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    coder = trie_bpe.TrieEncoder(PATH)
    assert coder.encode([t.encode() for t in texts]) == want
    assert [coder.decode(x) for x in want] == [library.decode(x, skip_special_tokens=False) for x in want]
    monkeypatch.setattr(trie_bpe, "CACHE_WORDS", 50)
    monkeypatch.setattr(trie_bpe, "CACHE_PAIRS", 50)
    small = trie_bpe.TrieEncoder(PATH)
    assert [small.encode([t.encode()])[0] for t in texts[:300]] == want[:300]


def test_ids_and_decoding(spark, awkward, library):
    frame = trie_bpe.encode_texts(awkward, PATH, with_text=True)
    assert frame.columns == [*awkward.columns, "ids"]
    for r in trie_bpe.decode_ids(frame, PATH).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_no_cycle_search_while_encoding():
    import gc

    from corpusmill.llm.trie_bpe import uncollected

    assert gc.isenabled()
    with uncollected():
        assert not gc.isenabled()
    assert gc.isenabled()


def random_words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß", k=rng.randrange(4, 14))) for _ in range(n)]


def test_keeps_nothing_of_the_words():
    coder = trie_bpe.TrieEncoder(PATH)
    coder.encode([" ".join(random_words(1, 1_000)).encode()])
    text = " ".join(random_words(2, 30_000)).encode()
    tracemalloc.start()
    coder.encode([text])
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 1_000_000


def test_no_python_step_per_word():
    coder = trie_bpe.TrieEncoder(PATH)
    text = " ".join(w for w in random_words(3, 30_000) if w.isascii()).encode()
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    coder.encode([text])
    sys.setprofile(None)
    assert calls < 5_000


def test_long_pieces(library, monkeypatch):
    """Pieces around the bound of the level walk, and tries of few pieces."""
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcé", k=k)) for k in (255, 256, 257, 700, 3_000)] + ["x" * 256 + " " + "x" * 257 + "'s", "中文" * 400]
    texts += [" ".join(texts + random_words(5, 200)), "", "\t a  b\x0b"]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert trie_bpe.TrieEncoder(PATH).encode([t.encode() for t in texts]) == want
    monkeypatch.setattr(trie_bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(trie_bpe, "LEVELS", 5)
    assert trie_bpe.TrieEncoder(PATH).encode([t.encode() for t in texts]) == want


def test_slices_of_a_batch(spark, library, monkeypatch):
    texts = [None, "", *(" ".join(random_words(k, 40)) for k in range(30)), "  ", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(trie_bpe, "SLICE_BYTES", 700)
    check(trie_bpe.token_digests(frame, PATH).collect(), list(enumerate(texts)), library)
    for r in trie_bpe.encode_texts(frame, PATH, with_text=True).collect():
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
