"""Collocations: phrases whose words come together more often than their parts would suggest.

Texts are lower-cased (A-Z), cut into pieces at punctuation and newlines, pieces into words. Every n-gram inside a piece gets a
64-bit Rabin-Karp fingerprint from prefix polynomials over the hashes of a whole chunk of texts, its language mixed in. Map
tasks count fingerprints per chunk, one shuffle brings packed counts together by leading bits, where they are added up in an array
of fixed size (8 MB), and those that reach ``least`` are nominated. A longer n-gram
is only fingerprinted where the words, and then the pairs, inside it are nominated, as a phrase is never more frequent than
its parts; nominations travel as a bitmap of ``2^BITMAP_BITS`` bits (8 MB), one bit per fingerprint. A bit that two
fingerprints share lets more n-grams through and never loses one, so the size of the vocabulary changes cost, not results. For the
same reason n-grams are counted by the first ``COUNT_BITS`` bits of their fingerprints, which moves half the bytes: those that share
them are counted together, and all of them are nominated if their sum is frequent.

Fingerprints only nominate. A last pass looks at the text behind every nominated occurrence: in a chunk, words get exact
numbers (the bytes of every word are compared with those of the first word of equal hash), phrases are sequences of such
numbers, and only these distinct frequent phrases become strings, each with its count and its occurrence pointer: the first document it
stands in. Counts are then summed by the phrase itself, so fingerprints that collide cannot change a result.

Defined results: null texts are empty, a null language is ``und``; phrases join words by one space whatever separated
them; ids may repeat or be null (``first_doc`` is the smallest id, null where there is none). Texts are read whole; a chunk
holds at least one text. Columns other than the id, text and language have no effect. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.arrays import byte_set, chunks, hash_spans, mix, spans, task
from corpusmill.session import materialize

BITMAP_BITS = 26
COUNT_BITS = 32  # leading bits of a fingerprint by which n-grams are counted for nomination
BUCKET_BITS = 12  # leading bits by which counts are shuffled; 8 and 16 of the other 20 bits travel in two columns
CHUNK = 4 << 20
SLICE = 1_024  # rows sorted by their ids at once
PART = 1 << 16  # words hashed or compared at once
UNKNOWN = "und"

# What separates pieces, and words inside a piece.
_CUT = byte_set((0x2E, 0x2E), (0x2C, 0x2C), (0x3A, 0x3B), (0x21, 0x21), (0x3F, 0x3F), (0x0A, 0x0D))
_WORD = ~(_CUT | byte_set((0x20, 0x20), (0x09, 0x09)))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of a chunk of texts: spans, piece numbers, hashes with their language, prefix polynomial."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, language: np.ndarray):
        self.raw = _LOWER[raw]
        self.starts, self.ends, self.row = spans(self.raw, at, _WORD)
        n = len(self.starts)
        parts = [hash_spans(self.raw, self.starts[k : k + PART], self.ends[k : k + PART], fold=False) for k in range(0, n, PART)]
        self.plain = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        cuts = np.concatenate(([0], np.cumsum(_CUT[raw], dtype=np.int64)))[self.starts]
        new = np.ones(n, bool)
        new[1:] = (self.row[1:] != self.row[:-1]) | (cuts[1:] != cuts[:-1])
        self.piece = np.cumsum(new)
        self.language = language[self.row] if n else np.zeros(0, np.uint64)
        value = mix(self.plain + self.language)
        self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * powers(_BASE, n)[:n])))
        self.back = powers(_INVERSE, n)

    def inside(self, size: int) -> np.ndarray:
        """Where ``size`` words from here on lie in one piece."""
        last = len(self.starts) - size + 1
        return self.piece[:last] == self.piece[size - 1 :] if last > 0 else np.zeros(0, bool)

    def fingerprints(self, size: int) -> np.ndarray:
        """Fingerprint of the ``size`` words from each word on: difference of two prefixes, shifted back to the origin."""
        last = len(self.starts) - size + 1
        if last <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[size:] - self.prefix[:last]) * self.back[:last] + np.uint64(size))

    def exact_numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """Equal words as equal numbers, and the place of the first word of each number."""
        _, first, number = np.unique(self.plain, return_index=True, return_inverse=True)
        sizes, like = self.ends - self.starts, first[number]
        same = sizes == sizes[like]
        # Compare the bytes of each word with those of the first one that has its hash.
        for at in range(0, len(sizes), PART):
            here = at + np.flatnonzero(same[at : at + PART])
            if len(here):
                size = sizes[here]
                heads = np.concatenate(([0], np.cumsum(size)[:-1]))
                step = np.arange(int(size.sum())) - np.repeat(heads, size)
                differs = self.raw[np.repeat(self.starts[here], size) + step] != self.raw[np.repeat(self.starts[like[here]], size) + step]
                same[here] = np.add.reduceat(differs, heads, dtype=np.int64) == 0
        # Words of equal hash and other bytes are numbered by their bytes.
        more: dict[bytes, int] = {}
        extra = []
        for k in np.flatnonzero(~same):
            word = self.raw[self.starts[k] : self.ends[k]].tobytes()
            if (int(number[k]), word) not in more:
                more[int(number[k]), word] = len(first) + len(extra)
                extra.append(k)
        for k in np.flatnonzero(~same):
            number[k] = more[int(number[k]), self.raw[self.starts[k] : self.ends[k]].tobytes()]
        return number, np.concatenate((first, np.array(extra, np.int64)))


def allowed(words: Words, size: int, seen: dict[int, np.ndarray], bits: int) -> np.ndarray:
    """Where an n-gram lies in one piece and all its parts of nominated sizes are nominated."""
    ok = words.inside(size)
    for part, bitmap in seen.items():
        if part <= size and len(ok):
            spot = words.fingerprints(part) >> np.uint64(64 - bits)
            there = (bitmap[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0
            for k in range(size - part + 1):
                ok &= there[k : k + len(ok)]
    return ok


def _language_numbers(column: pa.Array) -> np.ndarray:
    """A 64-bit number for each row's language, the same in every task."""
    coded = column.cast(pa.string()).fill_null(UNKNOWN).dictionary_encode()
    names = [name.encode() for name in coded.dictionary.to_pylist()]
    raw = np.frombuffer(b"".join(names), np.uint8)
    ends = np.cumsum([len(name) for name in names])
    hashed = np.zeros(len(names), np.uint64)
    full = np.array([len(name) > 0 for name in names], bool)
    if full.any():
        hashed[full] = hash_spans(raw, (ends - [len(name) for name in names])[full], ends[full], fold=False)
    return mix(hashed + np.uint64(1))[np.asarray(coded.indices)] if len(names) else np.zeros(0, np.uint64)


def _count_fingerprints(sizes: list[int], shared, bits: int, least: int):
    """Task: fingerprints and occurrences of each chunk's n-grams of the given sizes, packed by bucket."""

    @task()
    def run(batches):
        seen = {size: np.frombuffer(data, np.uint8) for size, data in shared.value.items()}
        for batch in batches:
            language = _language_numbers(batch.column(0))
            for row, raw, at in chunks(batch.column(1), CHUNK):
                words = Words(raw, at, language[row:])
                found = [words.fingerprints(size)[allowed(words, size, seen, bits)] >> np.uint64(64 - COUNT_BITS) for size in sizes]
                found, n = np.unique(np.concatenate(found), return_counts=True)
                if len(found):
                    yield _pack(found, n, least)

    return run


def _count_type(least: int) -> np.dtype:
    """Counts are clipped at ``least``, which changes no comparison of their sum with it."""
    return np.dtype(np.uint8 if least < 1 << 8 else np.int64)


def _binaries(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """One binary value for the numbers between each two edges."""
    offsets = (edges * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _numbers(column: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of binary values in a row, and the edges of the values."""
    column = column.cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(column.buffers()[2], np.uint8)[edges[0] : edges[-1]].view(dtype)
    return values, (edges - edges[0]) // dtype.itemsize


def _pack(found: np.ndarray, n: np.ndarray, least: int) -> pa.RecordBatch:
    """Sorted distinct fingerprints with their counts, one row per bucket: what follows the bucket's bits, in two columns."""
    bucket = (found >> np.uint64(COUNT_BITS - BUCKET_BITS)).astype(np.int32)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(found)]))
    rest = found & np.uint64((1 << COUNT_BITS - BUCKET_BITS) - 1)
    counts = np.minimum(n, least).astype(_count_type(least))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[edges[:-1]]), _binaries((rest >> np.uint64(16)).astype(np.uint8), edges),
            _binaries((rest & np.uint64(0xFFFF)).astype(np.uint16), edges), _binaries(counts, edges),
        ],
        ["bucket", "high", "low", "n"],
    )


def _add_up(least: int):
    """Task over rows in the order of their buckets: the fingerprints whose counts reach ``least``.

    It holds the sums of one bucket, an array of fixed size, whatever the number of rows of the bucket.
    """
    width = COUNT_BITS - BUCKET_BITS

    def frequent(bucket, sums):
        found = (int(bucket) << width) + np.flatnonzero(sums >= least)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], ["fp"])

    @task()
    def run(batches):
        current, sums = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            buckets = np.asarray(batch.column(0))
            high, edges = _numbers(batch.column(1), np.dtype(np.uint8))
            low, _ = _numbers(batch.column(2), np.dtype(np.uint16))
            n, _ = _numbers(batch.column(3), _count_type(least))
            starts = np.concatenate(([0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]))
            for lo, hi in zip(starts[:-1], starts[1:]):
                if buckets[lo] != current:
                    if sums is not None:
                        yield from frequent(current, sums)
                    current, sums = buckets[lo], np.zeros(1 << width, np.int64)
                part = slice(edges[lo], edges[hi])
                np.add.at(sums, (high[part].astype(np.int64) << 16) | low[part], n[part].astype(np.int64))
        if sums is not None:
            yield from frequent(current, sums)

    return run


def _nominate(docs: DataFrame, sizes: list[int], seen: dict[int, bytes], least: int, bits: int) -> bytes:
    """Bitmap of the fingerprints of ``sizes`` that occur at least ``least`` times; its size is fixed by ``bits``."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)
    packed = "bucket int, high binary, low binary, n binary"
    counted = docs.select("lang", "text").mapInArrow(_count_fingerprints(sizes, shared, bits, least), packed)
    by_bucket = counted.repartition("bucket").sortWithinPartitions("bucket")
    frequent = by_bucket.mapInArrow(_add_up(least), "fp long")
    spot = F.shiftright("fp", COUNT_BITS - bits) + 1
    parts = frequent.groupBy(F.bitmap_bucket_number(spot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits"))
    out = bytearray(max((1 << bits) // 8, 4096))
    for part in parts.collect():  # at most 2^bits bits
        at = 4096 * (part["bucket"] - 1)
        out[at : at + 4096] = part["bits"]
    shared.unpersist()
    return bytes(out)


def _count_phrases(longest: int, shared, bits: int, names: list[str]):
    """Task: (language, size, phrase, occurrences, smallest document) of each chunk's nominated n-grams, by their words.

    The row of size 0 has the number of all words of a language.
    """

    def rows(batch, words, first_row):
        number, first = words.exact_numbers()
        texts = np.array([words.raw[words.starts[k] : words.ends[k]].tobytes().decode() for k in first], object)
        seen = {size: np.frombuffer(data, np.uint8) for size, data in shared.value.items()}
        labels = batch.column(1).slice(first_row)
        _, number_of_language = np.unique(words.language, return_inverse=True)
        # Rows are in the order of their ids, so the first occurrence is in the smallest document.
        for language in np.unique(number_of_language):
            there = np.flatnonzero(number_of_language == language)
            yield labels[int(words.row[there[0]])], 0, [""], np.array([len(there)]), words.row[there[:1]]
        rank = number_of_language.astype(np.int64)
        for size in range(1, longest + 1):
            last = len(number) - size + 1
            if last <= 0:
                break
            # Rank of (language, word, ..., word): equal ranks are equal sequences.
            _, rank = np.unique(rank[:last] * len(first) + number[size - 1 :], return_inverse=True)
            at = np.flatnonzero(allowed(words, size, seen, bits))
            _, start, n = np.unique(rank[at], return_index=True, return_counts=True)
            start = at[start]
            order = np.argsort(number_of_language[start], kind="stable")
            start, n = start[order], n[order]
            for part in np.split(np.arange(len(start)), np.flatnonzero(np.diff(number_of_language[start])) + 1):
                if len(part):
                    here = start[part]
                    phrases = texts[number[here]]
                    for k in range(1, size):
                        phrases = phrases + " " + texts[number[here + k]]
                    yield labels[int(words.row[here[0]])], size, phrases, n[part], words.row[here]

    @task()
    def run(batches):
        # Sorting copies texts, so a batch is taken in slices.
        for batch in (whole.slice(lo, SLICE) for whole in batches for lo in range(0, whole.num_rows, SLICE)):
            batch = batch.take(pc.sort_indices(batch.column(0)))
            language = _language_numbers(batch.column(1))
            for first_row, raw, at in chunks(batch.column(2), CHUNK):
                words = Words(raw, at, language[first_row:])
                if not len(words.starts):
                    continue
                for label, size, phrases, n, row in rows(batch, words, first_row):
                    name = label.as_py() if label.is_valid else UNKNOWN
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(n), pa.string()), pa.array(np.full(len(n), size, np.int32)), pa.array(phrases, pa.string()),
                            pa.array(n.astype(np.int64)), batch.column(0).take(pa.array(first_row + row)),
                        ],
                        names,
                    )

    return run


def phrase_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: int = 30, longest: int = 4, bits: int = BITMAP_BITS,
) -> DataFrame:
    """Phrases of 1 to ``longest`` words that occur at least ``least`` times in a language: ``lang``, ``size``, ``phrase``,
    ``a`` (occurrences), ``first_doc``; the row of size 0 has the number of all words of the language."""
    own = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    seen: dict[int, bytes] = {}
    for sizes in ([1], [2], list(range(3, longest + 1))):
        sizes = [size for size in sizes if size <= longest]
        if sizes:
            bitmap = _nominate(own, sizes, seen, least, bits)
            seen |= {size: bitmap for size in sizes}
    shared = docs.sparkSession.sparkContext.broadcast(seen)
    names = ["lang", "size", "phrase", "n", "first_doc"]
    types = [T.StringType(), T.IntegerType(), T.StringType(), T.LongType(), own.schema["id"].dataType]
    schema = T.StructType([T.StructField(*x) for x in zip(names, types)])
    found = own.mapInArrow(_count_phrases(longest, shared, bits, names), schema)
    total = found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("a"), F.min("first_doc").alias("first_doc"))
    return total.filter((F.col("size") == 0) | (F.col("a") >= least))


def _ratio(a: Column, whole: Column) -> Column:
    """floor(2,000,000 * a / whole), exact beyond 64 bits."""
    return F.call_function("div", a.cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)"), whole.cast("decimal(20,0)")).cast("long")


def weakest_cuts(counts: DataFrame) -> DataFrame:
    """Candidates (two words or more) with ``l``, ``r`` and ``score`` of their lowest-scoring cut, ties to the first one."""
    words = F.split("phrase", " ")
    candidates = counts.filter(F.col("size") >= 2).select("lang", "size", "phrase", "a", "first_doc", words.alias("words"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "size", "phrase", "a", "first_doc", "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    part = counts.filter(F.col("size") >= 1)
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    scored = cuts.withColumn("score", _ratio(F.col("a"), F.col("l").cast("decimal(20,0)") + F.col("r")))
    first = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "size", "phrase", "a", "first_doc").agg(first).select("lang", "size", "phrase", "a", "first_doc", "cut.l", "cut.r", "cut.score")


def not_covered(candidates: DataFrame, share: int = 80) -> DataFrame:
    """Candidates that no longer candidate contains with ``share`` percent or more of their occurrences."""
    words = F.split("phrase", " ")
    places = F.expr("explode(flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), p -> array_join(slice(words, p, s), ' ')))))")
    longer = candidates.filter(F.col("size") >= 3).select("lang", "size", F.col("a").alias("whole"), words.alias("words"))
    most = longer.select("lang", places.alias("phrase"), "whole").groupBy("lang", "phrase").agg(F.max("whole").alias("most"))
    joined = candidates.join(most, ["lang", "phrase"], "left")
    return joined.filter(F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(share) * F.col("a"))).drop("most")


def mine_collocations(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    least: int = 30, longest: int = 4, share: int = 80, top: int = 2_000, bits: int = BITMAP_BITS,
) -> DataFrame:
    """Each language's best ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``, ``first_doc``.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the language; the score is
    floor(2,000,000 * a / (l + r)) of that cut. Order: score and ``a`` falling, then the phrase's bytes.
    """
    counts = materialize(phrase_counts(docs, id_col, text_col, lang_col, least, longest, bits), "phrases")
    left = not_covered(weakest_cuts(counts), share)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    words = counts.filter(F.col("size") == 0).select("lang", F.col("a").alias("n"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_doc")
