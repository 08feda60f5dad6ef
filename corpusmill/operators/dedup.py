"""Duplicate removal by key hash, vector similarity and simhash, all in first-come order.

Every operator returns ``(kept, removed)``: the kept records with all their columns, and the order numbers
(``seq``) of the removed ones. ``seq`` must be unique.
"""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from corpusmill.constants import SIMHASH_DISTANCE
from corpusmill.functions.common import in_slices
from corpusmill.operators.resolver import removed_by_first_come
from corpusmill.session import materialize

BITS = 64
_NOT_WORD = re.compile(r"[^\w一-鿌]+")


# ---------------------------------------------------------------- key hash


def hash_key(id_: Column, title: Column, language: Column, content: Column, prefix: int | None = None) -> Column:
    """md5 of the id (or title_language when there is none) followed by the text, or its first ``prefix`` characters."""
    name = F.concat(F.coalesce(title, F.lit("")), F.lit("_"), F.coalesce(language, F.lit("")))
    base = F.coalesce(F.when(id_ != "", id_), name)
    text = content if prefix is None else F.substring(content, 1, prefix)
    return F.md5(F.concat(base, F.coalesce(text, F.lit(""))))


def first_per_key(df: DataFrame, key: Column, seq: str = "seq") -> DataFrame:
    """Order numbers of the first row of each key.

    Partial aggregation folds a hot key inside each map task; no task ever sees all its rows.
    """
    return df.select(key.alias("key"), F.col(seq)).groupBy("key").agg(F.min(seq).alias(seq)).select(seq)


def deduplicate_by_hash(records: DataFrame, seq: str = "seq", prefix: int | None = None) -> tuple[DataFrame, DataFrame]:
    """First record of each ``hash_key``. Records are matched with the list of removed ones, which is the short one."""
    key = hash_key(F.col("id"), F.col("title"), F.col("language"), F.col("content"), prefix)
    removed = records.select(seq).join(first_per_key(records, key, seq), seq, "left_anti")
    return records.join(removed, seq, "left_anti"), removed


# ---------------------------------------------------------------- simhash


def _shingle_hash(shingle: str) -> int:
    return int.from_bytes(hashlib.md5(shingle.encode("utf-8", "surrogatepass")).digest()[-8:], "big")


def _votes(shingles: list[str]) -> np.ndarray:
    """One row of 64 bits per shingle."""
    hashes = np.array([_shingle_hash(s) for s in shingles], dtype=">u8")
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)


def _sign(votes: np.ndarray) -> int:
    """Majority of each bit column as a signed 64-bit number."""
    ones = votes.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(votes)).tobytes(), "big", signed=True)


def _simhash(text: str) -> int:
    return _sign(_votes([text[i : i + 4] for i in range(max(len(text) - 3, 1))]))


def _simhashes(texts: list[str]) -> list[int]:
    """Fingerprints of several texts of basic-plane characters, each at least four long.

    A shingle is then one 64-bit number, and each distinct shingle of the group is hashed once.
    """
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), dtype="<u2").astype(np.uint64)
    keys = points[:-3] << 48 | points[1:-2] << 32 | points[2:-1] << 16 | points[3:]
    distinct, place = np.unique(keys, return_inverse=True)
    spelled = distinct.astype(">u8").tobytes().decode("utf-16-be", "surrogatepass")
    votes = _votes([spelled[i : i + 4] for i in range(0, len(spelled), 4)])
    ends = np.cumsum([len(t) for t in texts])
    return [_sign(votes[place[end - len(t) : end - 3]]) for t, end in zip(texts, ends)]


def _groups(texts: list[str], characters: int = 500_000):
    """Runs of texts of bounded total length."""
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= characters:
            yield group
            group, size = [], 0
    if group:
        yield group


@F.arrow_udf(LongType())
def _fingerprint(texts: pa.Array) -> pa.Array:
    def prints(part: list) -> list[int]:
        words = [_NOT_WORD.sub("", (t or "").lower()) for t in part]
        plain = [len(w) > 3 and max(w) <= "\uffff" for w in words]
        grouped = (f for group in _groups([w for w, p in zip(words, plain) if p]) for f in _simhashes(group))
        return [next(grouped) if p else _simhash(w) for w, p in zip(words, plain)]

    return in_slices(prints, pa.int64(), texts, rows=512)


def simhash_fingerprints(records: DataFrame, seq: str = "seq", content: str = "content") -> DataFrame:
    """(seq, fingerprint): 64-bit simhash of the word characters of the whole lower-cased text.

    Row by row in Arrow batches, without a shuffle: exploding every shingle into rows to sum 64 votes in SQL was
    several times slower.
    """
    return records.select(seq, _fingerprint(content).alias("fingerprint"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _block_masks(distance: int, blocks: int) -> list[int]:
    """Bit masks of all ways to keep ``blocks - distance`` of the blocks: equal bits there are implied."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(kept) for kept in combinations(parts, blocks - distance)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _flips(value: Column, radius: int) -> Column:
    """Array of all values within ``radius`` flipped bits."""
    masks = [0]
    for r in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(BITS), r)]
    literal = F.from_json(F.lit(str([_signed(m) for m in masks])), "array<bigint>")
    return F.transform(literal, lambda m: value.bitwiseXOR(m))


def hamming_pairs(
    fingerprints: DataFrame,
    distance: int = SIMHASH_DISTANCE,
    blocks: int = 6,
    bucket_limit: int = 1000,
) -> DataFrame:
    """All pairs ``lo < hi`` (by ``seq``) of rows with different fingerprints at most ``distance`` bits apart.

    Fingerprints must be distinct per row. With ``blocks`` blocks of bits, a close pair agrees on at least
    ``blocks - distance`` of them, so joining on every such choice misses nothing (Manku et al. 2007). Six
    blocks and distance 3 give 20 keys of 32 bits.

    A key shared by more than ``bucket_limit`` fingerprints is not joined within itself. Its members look
    each other up by flipped bits instead: two values at distance d meet at a value that is ceil(d/2) flips
    from one and floor(d/2) from the other. That costs a fixed number of rows per fingerprint however large
    the bucket is, and it is exact as well.
    """
    fingerprints = materialize(fingerprints.select("seq", "fingerprint"), "fingerprints")
    masks = _block_masks(distance, blocks)
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("bits"))
            for i, m in enumerate(masks)
        ]
    )
    keyed = fingerprints.select("seq", "fingerprint", F.explode(keys).alias("k")).select(
        "seq", "fingerprint", "k.choice", "k.bits"
    )
    sizes = materialize(
        keyed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes"
    )
    hot = sizes.filter(F.col("size") > bucket_limit).select("choice", "bits")
    shared = keyed.join(sizes, ["choice", "bits"])
    small = shared.filter(F.col("size") <= bucket_limit).drop("size")
    a = small.select("choice", "bits", F.col("seq").alias("lo"), F.col("fingerprint").alias("f"))
    b = small.select("choice", "bits", F.col("seq").alias("hi"), F.col("fingerprint").alias("g"))
    close = hamming(F.col("f"), F.col("g")) <= distance
    pairs = a.join(b, ["choice", "bits"]).filter((F.col("lo") < F.col("hi")) & close).select("lo", "hi")
    if not hot.isEmpty():
        members = materialize(
            keyed.join(hot, ["choice", "bits"], "left_semi").select("seq", "fingerprint").distinct(), "hot"
        )
        far = members.select(
            F.col("seq").alias("s"), F.col("fingerprint").alias("f"),
            F.explode(_flips(F.col("fingerprint"), (distance + 1) // 2)).alias("meet"),
        )
        near = members.select(
            F.col("seq").alias("t"), F.col("fingerprint").alias("g"),
            F.explode(_flips(F.col("fingerprint"), distance // 2)).alias("meet"),
        )
        met = far.join(near, "meet").filter((F.col("s") != F.col("t")) & close)
        pairs = pairs.unionByName(
            met.select(F.least("s", "t").alias("lo"), F.greatest("s", "t").alias("hi"))
        )
    return pairs.distinct()


def simhash_removed(
    fingerprints: DataFrame, distance: int = SIMHASH_DISTANCE, blocks: int = 6, bucket_limit: int = 1000
) -> DataFrame:
    """Order numbers removed by the first-come rule, from (seq, fingerprint).

    Equal fingerprints are folded to their first row before any pair is formed; this leaves the result
    unchanged, because a later copy is removed by, or together with, the first one.
    """
    fingerprints = materialize(fingerprints.select("seq", "fingerprint"), "fingerprints")
    first = fingerprints.groupBy("fingerprint").agg(F.min("seq").alias("seq"))
    pairs = hamming_pairs(first.select("seq", "fingerprint"), distance, blocks, bucket_limit)
    copies = fingerprints.select("seq").join(first.select("seq"), "seq", "left_anti")
    return copies.unionByName(removed_by_first_come(pairs))


def deduplicate_by_simhash(
    records: DataFrame, distance: int = SIMHASH_DISTANCE, seq: str = "seq", **options
) -> tuple[DataFrame, DataFrame]:
    fingerprints = simhash_fingerprints(records, seq).withColumnRenamed(seq, "seq")
    removed = simhash_removed(fingerprints, distance, **options).withColumnRenamed("seq", seq)
    return records.join(removed, seq, "left_anti"), removed
