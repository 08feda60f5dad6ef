"""Words of many rows as numbers, in chunks of bounded size that each have a list of their own words.

What has to be known of a word (how many rows have it, its number in the whole table) is a join by word. Sending every
word of every row to it writes the texts several times over. Here a chunk sends each of its words once, and the answer
comes back as one list a chunk. The vocabulary stays a table: a task holds that of one chunk only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialize

CHUNK_WORDS = 1 << 21
_CODEC = "zstd"


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes: the first byte of each, then the second of each, and so on."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    raw = values.dtype.char.encode() + np.int64(len(values)).tobytes() + planes.tobytes()
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec=_CODEC, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[8:], int(np.frombuffer(data[:8], np.int64)[0]), codec=_CODEC, asbytes=True)
    dtype = np.dtype(raw[:1].decode())
    n = int(np.frombuffer(raw[1:9], np.int64)[0])
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, offset=9).reshape(dtype.itemsize, n).T).view(dtype).ravel()


def sizes(lists: pa.Array) -> np.ndarray:
    """Lengths of the lists of a column, 0 for null."""
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)


def text_words(texts: pa.Array) -> np.ndarray:
    """Words of each text, from the lists of words of its sentences."""
    n = sizes(texts)
    return np.bincount(np.repeat(np.arange(len(n)), n), weights=sizes(texts.flatten()), minlength=len(n)).astype(np.int64)


def column(table: pa.Table, name: str) -> pa.Array:
    out = table.column(name).combine_chunks()
    return pa.concat_arrays(out.chunks) if isinstance(out, pa.ChunkedArray) else out


def coded(words: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in ascending order, and the place of each word among them."""
    found = words.dictionary_encode(null_encoding="encode")
    names, place = found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if lower and len(names):
        names, again = coded(pa.array([n.lower() for n in names.to_pylist()], pa.string()))
        return names, again[place]
    order = np.asarray(pc.sort_indices(names), dtype=np.int64)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return names.take(pa.array(order)), rank[place] if len(order) else place


def runs(keys: pa.Array, together: bool) -> np.ndarray:
    """The number of each row's group: rows of equal keys that follow one another, or every row by itself."""
    if not together or not len(keys):
        return np.arange(len(keys))
    listed = keys.to_pylist()
    return np.cumsum([0] + [a != b for a, b in zip(listed, listed[1:])])


def _pieces(batches: Iterator[pa.RecordBatch], key: str, n_words: Callable, together: bool) -> Iterator[pa.Table]:
    """Tables of about ``CHUNK_WORDS`` words; rows of equal keys stay together where asked for."""
    held, n, last = [], 0, None
    for batch in batches:
        keys = batch.column(key).to_pylist() if together else None
        start = 0
        for i, size in enumerate(n_words(batch).tolist()):
            if n >= CHUNK_WORDS and not (together and keys[i] == last):
                yield pa.Table.from_batches([*held, batch.slice(start, i - start)])
                held, n, start = [], 0, i
            n += size
            last = keys[i] if together else None
        held.append(batch.slice(start))
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def chunked(rows: DataFrame, key: str, n_words: Callable, encode: Callable, together: bool, name: str) -> DataFrame:
    """A written table with one row a chunk: ``chunk``, its ``keys``, ``terms`` with their ``counts``, and ``body``.

    ``encode`` gets the rows of a chunk and gives words, counts and arrays of numbers. With ``together`` rows of one key come
    in one chunk, one after another.
    """
    if together:
        rows = rows.repartition(key).sortWithinPartitions(key)
    kind = rows.schema[key].dataType.simpleString()
    ddl = f"chunk bigint, keys array<{kind}>, terms array<string>, counts array<int>, body array<binary>"

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        for i, table in enumerate(_pieces(batches, key, n_words, together)):
            terms, counts, body = encode(table)
            own = column(table, key)
            whole = [lists([len(v)], v) for v in (own, terms, pa.array(counts, pa.int32()))]
            packed = pa.array([[pack(a) for a in body]], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([first + i], pa.int64()), *whole, packed], names=["chunk", "keys", "terms", "counts", "body"])

    return materialize(rows.mapInArrow(run, ddl), name)


def listed_terms(chunks: DataFrame) -> DataFrame:
    """``chunk``, ``pos``, ``term``, ``n``: the words of each chunk with their places and counts there."""
    both = F.posexplode(F.arrays_zip("terms", "counts")).alias("pos", "t")
    return chunks.select("chunk", both).select("chunk", "pos", F.col("t.terms").alias("term"), F.col("t.counts").alias("n"))


def answered(chunks: DataFrame, values: DataFrame, decode: Callable, ddl: str) -> DataFrame:
    """The rows that ``decode`` makes of each chunk and the values (``chunk``, ``pos``, ``value``) of its words.

    ``decode(keys, terms, body, pos, value)`` gives a table. Words without a value are not among ``pos``.
    """

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, terms = (column(left, c).flatten() for c in ("keys", "terms"))
        body = [unpack(b) for b in left.column("body")[0].as_py()]
        return decode(keys, terms, body, *(column(right, c).to_numpy(zero_copy_only=False) for c in ("pos", "value")))

    # New names, as both may come from one table.
    own = chunks.select(F.col("chunk").alias("own"), "keys", "terms", "body").groupBy("own")
    return own.cogroup(values.select(F.col("chunk").alias("asked"), "pos", "value").groupBy("asked")).applyInArrow(both, ddl)


def lists(ends: np.ndarray, values) -> pa.ListArray:
    """Lists of ``values`` that end at ``ends``."""
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values)
