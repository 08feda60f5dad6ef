"""Sparse term vectors with exact document frequencies, and their exact cosine near-duplicates.

A vector is two arrays of equal length: terms, and weights of a unit vector. Nothing is hashed and nothing grows with the
vocabulary but tables: frequencies stay distributed and are joined to the postings of the documents.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.constants import EMBEDDING_THRESHOLD
from corpusmill.functions.common import SLICE_ROWS, all_finite
from corpusmill.functions.keywords import tokens
from corpusmill.operators.chunks import answered, chunked, coded, column, listed_terms, lists, pack, runs, sizes, unpack
from corpusmill.operators.resolver import removed_by_first_come
from corpusmill.session import materialize, unstage

SLACK = 1e-6
GROUP_TERMS = 1 << 23
GROUP_PAIRS = 1 << 22
COMPARED_ROWS = 4096


def _counted(table: pa.Table) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """Distinct words of a chunk, the rows that have each, and for every row its number of words, their places and counts."""
    words = column(table, "words")
    names, place = coded(words.flatten(), lower=True)
    n = sizes(words)
    width = max(1, len(names))
    pairs, tf = np.unique(np.repeat(np.arange(len(n)), n) * width + place, return_counts=True)
    row, place = np.divmod(pairs, width)
    body = [np.bincount(row, minlength=len(n)), place, tf]
    return names, np.bincount(place, minlength=len(names)), [x.astype(np.int32) for x in body]


def _weighed(total: float, together: bool):
    """Unit vectors of a chunk from its counts and the document frequencies of its words, 1 where none is given."""

    def decode(keys: pa.Array, terms: pa.Array, body: list[np.ndarray], pos: np.ndarray, value: np.ndarray) -> pa.Table:
        n, place, tf = body
        df = np.ones(len(terms))
        df[pos.astype(np.int64)] = value
        w = tf * np.log((total + 1) / (df[place] + 1))
        group = runs(keys, together)
        own = np.repeat(group, n)
        order = np.lexsort((w, place, own)) if together else np.arange(len(w))
        order = order[w[order] > 0]
        w, place, own = w[order], place[order], own[order]
        size = np.bincount(own, minlength=len(keys))
        unit = (w / np.sqrt(np.bincount(own, weights=w * w, minlength=len(keys)))[own]).astype(np.float32)
        first = np.searchsorted(group, np.flatnonzero(size))
        ends = np.cumsum(size[size > 0])
        return pa.Table.from_arrays([keys.take(pa.array(first)), lists(ends, terms.take(pa.array(place))), lists(ends, unit)], names=["key", "terms", "weights"])

    return decode


def term_vectors(docs: DataFrame, content: str = "content", key: str = "seq", staged: bool = False) -> DataFrame:
    """``key``, ``terms`` (ascending) and ``weights``: unit tf-idf vectors with idf = ln((N + 1) / (df + 1)).

    ``key`` must be unique. Terms that are in every document have no weight and are left out, so a text may have an empty vector. Terms
    of one document only need no join: their frequency is 1 where none is found. ``staged`` writes the vectors, for readers that join them.
    """
    rows = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    together = (rows["most"] or 0) > 1
    words = docs.select(F.col(key).alias("key"), tokens(F.col(content)).alias("words"))
    chunks = chunked(words, "key", lambda batch: sizes(batch.column("words")), _counted, together, "postings")
    df = F.sum("n").over(Window.partitionBy("term"))
    frequent = listed_terms(chunks).select("chunk", "pos", df.alias("value")).filter("value > 1")
    ddl = f"key {docs.schema[key].dataType.simpleString()}, terms array<string>, weights array<float>"
    out = answered(chunks, frequent, _weighed(float(rows["n"] or 0), together), ddl).withColumnRenamed("key", key)
    if staged:
        out = materialize(out, "term_vectors")
        unstage(chunks)
    return out


def _vector_chunk(table: pa.Table) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """Words of a chunk of vectors with the vectors that have each, and the vectors: sizes, places, weights, digests, and whether a term comes twice."""
    terms, weights = column(table, "terms"), column(table, "weights")
    flat, w = terms.flatten(), weights.flatten().to_numpy(zero_copy_only=False)
    names, place = coded(flat)
    n = sizes(terms)
    row = np.repeat(np.arange(len(n)), n)
    pairs = np.sort(row * max(1, len(names)) + place)
    twice = np.zeros(len(n), dtype=np.int8)
    twice[pairs[1:][pairs[1:] == pairs[:-1]] // max(1, len(names))] = 1
    # Equal vectors have one digest of their terms and weights.
    spelled = [t.encode("utf-8", "surrogatepass") if t is not None else b"\xff" for t in names.to_pylist()]
    own = [hashlib.blake2b(s, digest_size=16).digest() for s in spelled]
    own = np.frombuffer(b"".join(own), np.uint8).reshape(-1, 16)[place] if own else np.zeros((0, 16), np.uint8)
    plain = w + w.dtype.type(0)
    digests, at = [], 0
    for end in np.cumsum(n):
        digests.append(hashlib.blake2b(own[at:end].tobytes() + plain[at:end].tobytes(), digest_size=16).digest())
        at = end
    digest = np.frombuffer(b"".join(digests), np.int64)
    return names, np.bincount(place[w != 0], minlength=len(names)), [n.astype(np.int32), place.astype(np.int32), w, digest, twice]


def _vector_chunks(vectors: DataFrame) -> DataFrame:
    return chunked(vectors.select("seq", "terms", "weights"), "seq", lambda batch: sizes(batch.column("terms")), _vector_chunk, False, "vectors")


def _digests(chunks: DataFrame) -> DataFrame:
    """``seq``, ``a``, ``b``, ``twice``: the digest of each vector in two halves, and whether it names a term twice."""

    def run(batches):
        for batch in batches:
            for keys, body in zip(batch.column("keys"), batch.column("body")):
                digest, twice = (unpack(body[i].as_py()) for i in (3, 4))
                yield pa.RecordBatch.from_arrays([keys.values, pa.array(digest[::2]), pa.array(digest[1::2]), pa.array(twice == 1)], names=["seq", "a", "b", "twice"])

    kind = chunks.schema["keys"].dataType.elementType.simpleString()
    return chunks.select("keys", "body").mapInArrow(run, f"seq {kind}, a bigint, b bigint, twice boolean")


def _numbered(chunks: DataFrame, threshold: float) -> DataFrame:
    """Vectors by the numbers of their terms, which rise from rare to frequent: a written table, ``chunks`` is deleted.

    Of each vector: its length ``norm``; of its unit form ``total``, the sum of squares, and ``alone``, the part of that in terms no other vector
    has; ``twice``, the number of other terms, and these with their weights in a ``head``, the indexed terms, and a ``tail``. The head ends where
    what follows is shorter than ``threshold``.
    """
    bound = threshold * threshold - SLACK
    listed = listed_terms(chunks)
    frequent = listed.groupBy("term").agg(F.sum("n").alias("df")).filter("df > 1").orderBy("df", "term")
    numbers = materialize(frequent.select("term", F.monotonically_increasing_id().alias("value")), "terms")
    values = listed.join(numbers, "term").select("chunk", "pos", "value")
    kind = chunks.schema["keys"].dataType.elementType.simpleString()
    ddl = f"seq {kind}, norm double, total double, alone double, twice boolean, n int, head array<binary>, tail array<binary>"

    def decode(keys: pa.Array, terms: pa.Array, body: list[np.ndarray], pos: np.ndarray, value: np.ndarray) -> pa.Table:
        n, place, w, _, twice = body
        ids = np.full(len(terms), -1, dtype=np.int64)
        ids[pos.astype(np.int64)] = value
        ids = ids[place]
        row = np.repeat(np.arange(len(n)), n)
        squares = w.astype(np.float64) ** 2
        norm = np.sqrt(np.bincount(row, weights=squares, minlength=len(n)))
        squares = squares / norm[row] ** 2
        total = np.bincount(row, weights=squares, minlength=len(n))
        kept = np.lexsort((ids, row))
        kept = kept[ids[kept] >= 0]
        ids, w, row, squares = ids[kept], w[kept], row[kept], squares[kept]
        alone = total - np.bincount(row, weights=squares, minlength=len(n))
        size = np.bincount(row, minlength=len(n))
        at = np.concatenate(([0], np.cumsum(size)))
        until = np.concatenate(([0.0], np.cumsum(squares)))
        left = total[row] - alone[row] - (until[:-1] - until[at[:-1]][row])
        first = np.bincount(row, weights=left >= bound, minlength=len(n)).astype(np.int64)
        parts = [[[pack(ids[a:b]), pack(w[a:b])] for a, b in zip(s, e)] for s, e in ((at[:-1], at[:-1] + first), (at[:-1] + first, at[1:]))]
        packed = [pa.array(p, pa.list_(pa.binary())) for p in parts]
        return pa.Table.from_arrays([keys, pa.array(norm), pa.array(total), pa.array(alone), pa.array(twice == 1), pa.array(size, pa.int32()), *packed], schema=arrow)

    empty = chunks.sparkSession.createDataFrame([], ddl)
    arrow = to_arrow_schema(empty.schema)
    out = materialize(answered(chunks, values, decode, ddl), "unit")
    unstage(chunks, numbers)
    return out


def _index(unit: DataFrame) -> DataFrame:
    """``term``, ``seq``, ``w``, ``rest``: the head of each vector, each term with its weight and the length of what follows it."""

    def run(batches):
        for batch in batches:
            total, alone = (batch.column(c).to_numpy() for c in ("total", "alone"))
            heads = [[unpack(b) for b in pair] for pair in batch.column("head").to_pylist()]
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = range(start, min(start + SLICE_ROWS, batch.num_rows))
                w = [heads[i][1] / norm for i, norm in zip(part, batch.column("norm").to_numpy()[start:])]
                rest = [np.full(len(x), np.inf) if two else np.sqrt(np.maximum(total[i] - alone[i] - np.cumsum(x * x), 0.0)) for i, x, two in zip(part, w, batch.column("twice")[start:].to_pylist())]
                seq = batch.column("seq").take(pa.array(np.repeat(part, [len(x) for x in w])))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([heads[i][0] for i in part])), seq, *(pa.array(np.concatenate(x)) for x in (w, rest))], names=["term", "seq", "w", "rest"])

    kind = unit.schema["seq"].dataType.simpleString()
    rows = unit.select("seq", "norm", "total", "alone", "twice", "head").filter("seq IS NOT NULL")
    return rows.mapInArrow(run, f"term bigint, seq {kind}, w double, rest double")


class _Group:
    """The vectors of a group with a scratch array over all their terms."""

    def __init__(self, table: pa.Table):
        self.seq = column(table, "seq")
        self.norm, self.total, self.alone = (column(table, c).to_numpy(zero_copy_only=False) for c in ("norm", "total", "alone"))
        self.twice = np.asarray(column(table, "twice").to_pylist(), dtype=bool)
        ids, w = [], []
        for c in ("head", "tail"):
            if c in table.column_names:
                found = [[unpack(b) for b in pair] for pair in table.column(c).to_pylist()]
                ids.append([f[0] for f in found])
                w.append([f[1] / n for f, n in zip(found, self.norm)])
        self.size = np.array([sum(map(len, p)) for p in zip(*ids)], dtype=np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        self.id = np.concatenate([x for p in zip(*ids) for x in p]) if len(self.size) else np.zeros(0, np.int64)
        self.w = np.concatenate([x for p in zip(*w) for x in p]) if len(self.size) else np.zeros(0)
        names, self.place = np.unique(self.id, return_inverse=True)
        self.own = np.zeros(len(names))

    def dots(self, a: int, others: np.ndarray, least: float, whole: bool) -> np.ndarray:
        """Cosines of vector ``a`` with others. If only heads are here, the most that each can be."""
        mine = slice(self.at[a], self.at[a + 1])
        self.own[self.place[mine]] = self.w[mine]
        n = self.size[others]
        ends = np.cumsum(n)
        taken = np.arange(ends[-1]) + np.repeat(self.at[others] - (ends - n), n)
        row = np.repeat(np.arange(len(others)), n)
        w = self.w[taken]
        out = np.bincount(row, weights=self.own[self.place[taken]] * w, minlength=len(others))
        if not whole:
            # What both have and one head does not list comes after the end of the shorter head in both.
            last = self.id[self.at[a + 1] - 1] if self.size[a] else -1
            until = np.minimum(last, self.id[np.maximum(self.at[others + 1] - 1, 0)])
            until = np.where(n > 0, until, -1)
            before = np.bincount(row, weights=np.where(self.id[taken] <= last, w * w, 0.0), minlength=len(others))
            own = np.concatenate(([0.0], np.cumsum(self.w[mine] ** 2)))[np.searchsorted(self.id[mine], until, side="right")]
            left = [np.sqrt(np.maximum(self.total[i] - self.alone[i] - x, 0.0)) for i, x in ((a, own), (others, before))]
            out = np.where(self.twice[a] | self.twice[others], np.inf, out + left[0] * left[1])
        self.own[self.place[mine]] = 0.0
        return out


def _compared(least: float, whole: bool):
    """Pairs of a group with their cosines, of at least ``least``; those that cannot have it are left out if only heads are given."""

    def run(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        group = _Group(vectors)
        lo, hi = (np.asarray(pc.index_in(column(pairs, c), value_set=group.seq)) for c in ("lo", "hi"))
        order = np.argsort(lo, kind="stable")
        cosine = np.empty(len(lo))
        starts = np.flatnonzero(np.concatenate(([True], np.diff(lo[order]) != 0)))
        for start, end in zip(starts, [*starts[1:], len(order)]):
            for at in range(start, end, COMPARED_ROWS):
                own = order[at : min(at + COMPARED_ROWS, end)]
                cosine[own] = group.dots(lo[own[0]], hi[own], least, whole)
        kept = pa.array(np.flatnonzero(cosine >= (least if whole else least - SLACK)))
        return pa.Table.from_arrays([column(pairs, "lo").take(kept), column(pairs, "hi").take(kept), pa.array(cosine).take(kept)], names=["lo", "hi", "cosine"])

    return run


def _in_groups(pairs: DataFrame, unit: DataFrame, least: float, whole: bool) -> DataFrame:
    """Pairs compared in groups by their ``lo``: a vector is sent once to each group that needs it, not to each pair."""
    wanted = ["seq", "norm", "total", "alone", "twice", "head", *(["tail"] if whole else [])]
    n = unit.agg(F.sum("n").alias("n")).first()["n"] or 0
    most = max(pairs.sparkSession.sparkContext.defaultParallelism, n // GROUP_TERMS, pairs.count() // GROUP_PAIRS)
    dealt = pairs.select(F.pmod(F.xxhash64("lo"), F.lit(most)).alias("g"), "lo", "hi")
    needed = dealt.select("g", F.explode(F.array("lo", "hi")).alias("seq")).distinct()
    sent = needed.join(unit.select(*wanted), "seq").select(F.col("g").alias("to"), *wanted)
    kind = unit.schema["seq"].dataType.simpleString()
    return dealt.groupBy("g").cogroup(sent.groupBy("to")).applyInArrow(_compared(least, whole), f"lo {kind}, hi {kind}, cosine double")


def _measured(pairs: DataFrame, unit: DataFrame, least: float) -> DataFrame:
    """Pairs (``lo``, ``hi``) whose cosine is at least ``least``, with it.

    Heads are compared first: what they share and the most that the rest can give leave few pairs, and only of these whole vectors are sent.
    """
    pairs = materialize(pairs.select("lo", "hi"), "met")
    near = materialize(_in_groups(pairs, unit, least, False).select("lo", "hi"), "near")
    unstage(pairs)
    return _in_groups(near, unit, least, True)


def _reachable(threshold: float, a: str, b: str) -> Column:
    """Whether two vectors can be as close as ``threshold`` if the term of ``w{a}``, ``w{b}`` is the rarest that both have.

    They share nothing before it, and what follows gives at most the product of the lengths of both rests.
    """
    return F.col(f"w{a}") * F.col(f"w{b}") + F.col(f"rest{a}") * F.col(f"rest{b}") >= threshold - SLACK


def sparse_graph(vectors: DataFrame, threshold: float = EMBEDDING_THRESHOLD, with_cliques: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Pairs (``lo``, ``hi``, ``cosine``) with cosine >= threshold, and cliques whose inner pairs are left out. Exact.

    ``vectors`` has ``seq``, ``terms``, ``weights`` (unit or not, not zero). Terms are ordered from rare to frequent. Only a prefix of each vector is
    indexed: all terms until the length of the rest falls below the threshold. The rarest term that a close pair shares lies in both
    prefixes, as otherwise all that they share would lie in the rest of one, too short for the threshold. In the list of that term
    the pair also passes :func:`_reachable`, which is tested inside the join, so that few pairs leave it and have their vectors compared.

    Groups of near copies share all their terms, so pairs inside them are never formed: in every list of the index the first
    row leads, rows within half the threshold's angle of a leader join its clique, and lists are compared clique with clique.
    What stays quadratic is a list in which many rows are neither copies of one another nor of one leader.
    """
    return _graph(_numbered(_vector_chunks(vectors), threshold), None, threshold, with_cliques)


def _graph(unit: DataFrame, first: DataFrame | None, threshold: float, with_cliques: bool) -> tuple[DataFrame, DataFrame | None]:
    """:func:`sparse_graph` of the vectors that ``first`` names by ``seq``, or of all."""
    index = _index(unit)
    index = materialize(index if first is None else index.join(first.select("seq"), "seq", "left_semi").select("term", "seq", "w", "rest"), "index")
    if not with_cliques:
        side = lambda tag: index.select("term", *[F.col(c).alias(f"{c}{tag}") for c in ("seq", "w", "rest")])
        met = side("a").join(side("b"), "term").filter((F.col("seqa") < F.col("seqb")) & _reachable(threshold, "a", "b"))
        pairs = _measured(met.select(F.col("seqa").alias("lo"), F.col("seqb").alias("hi")).distinct(), unit, threshold)
        unstage(index)
        return pairs, None
    half = math.cos(math.acos(max(-1.0, min(1.0, threshold))) / 2) + SLACK
    first = index.groupBy("term").agg(F.min(F.struct("seq", "w", "rest")).alias("f")).select(
        "term", F.col("f.seq").alias("lo"), F.col("f.w").alias("wa"), F.col("f.rest").alias("resta")
    )
    led = index.select("term", F.col("seq").alias("hi"), F.col("w").alias("wb"), F.col("rest").alias("restb")).join(first, "term")
    led = led.filter((F.col("lo") < F.col("hi")) & _reachable(half, "a", "b")).select("lo", "hi").distinct()
    member = materialize(_measured(led, unit, half).groupBy(F.col("hi").alias("seq")).agg(F.min("lo").alias("clique")), "members")
    leaders = member.select(F.col("clique").alias("seq")).distinct().join(member.select("seq"), "seq", "left_anti")
    cliques = materialize(member.unionByName(leaders.withColumn("clique", F.col("seq"))).select("clique", "seq"), "cliques")
    own = F.coalesce(F.col("clique") * 2, F.col("seq") * 2 + 1)
    classes = materialize(index.join(cliques, "seq", "left").select("term", own.alias("class"), "seq", "w", "rest"), "classes")
    # A class is as near as the nearest of its members could be.
    listed = classes.groupBy("term", "class").agg(F.max(F.abs("w")).alias("w"), F.max("rest").alias("rest"))
    side = lambda tag: listed.select("term", *[F.col(c).alias(f"{c}{tag}") for c in ("class", "w", "rest")])
    met = side("a").join(side("b"), "term").filter((F.col("classa") < F.col("classb")) & _reachable(threshold, "a", "b")).select("term", "classa", "classb")
    side = lambda tag: classes.select("term", *[F.col(c).alias(f"{c}{tag}") for c in ("class", "seq", "w", "rest")])
    pairs = met.join(side("a"), ["term", "classa"]).join(side("b"), ["term", "classb"]).filter(_reachable(threshold, "a", "b"))
    pairs = pairs.select(F.least("seqa", "seqb").alias("lo"), F.greatest("seqa", "seqb").alias("hi")).distinct()
    pairs = _measured(pairs, unit, threshold)
    unstage(index, member, classes)
    return pairs, cliques


def usable(vectors: DataFrame) -> DataFrame:
    """Vectors that can be similar to something: no null or non-finite weight, and not all zero."""
    same = F.size("terms") == F.size("weights")
    return vectors.filter(same & F.exists("weights", lambda x: x != 0) & all_finite(F.col("weights")))


def sparse_cosine_pairs(vectors: DataFrame, threshold: float = EMBEDDING_THRESHOLD) -> DataFrame:
    """All pairs ``lo < hi`` with cosine >= threshold; the output itself may be quadratic.

    Equal vectors are compared once and written out at the end, unless vectors name a term twice, whose result depends on the order.
    """
    chunks = _vector_chunks(usable(vectors.select("seq", "terms", "weights")))
    digests = _digests(chunks)
    plain = digests.filter("twice").isEmpty()
    folded = digests.groupBy("a", "b", *([] if plain else ["seq"])).agg(F.sort_array(F.collect_set("seq")).alias("seqs"))
    folded = materialize(folded.select(F.get("seqs", F.lit(0)).alias("seq"), "seqs"), "folded")
    pairs = _graph(_numbered(chunks, threshold), folded, threshold, with_cliques=False)[0]
    members = lambda name, seq: folded.select(F.col("seq").alias(name), F.explode("seqs").alias(seq))
    between = pairs.join(members("lo", "s"), "lo").join(members("hi", "t"), "hi").select(F.least("s", "t").alias("lo"), F.greatest("s", "t").alias("hi"), "cosine")
    inside = folded.filter(F.size("seqs") > 1).select("seqs", F.posexplode("seqs").alias("i", "lo"))
    inside = inside.select("lo", F.explode(F.slice("seqs", F.col("i") + 2, F.size("seqs"))).alias("hi"), F.lit(1.0).alias("cosine"))
    return between.unionByName(inside.filter(F.col("cosine") >= threshold))


def terms_removed(vectors: DataFrame, threshold: float = EMBEDDING_THRESHOLD) -> DataFrame:
    """Order numbers removed by the first-come rule. Equal vectors are folded to their first row beforehand."""
    chunks = _vector_chunks(usable(vectors.select("seq", "terms", "weights")))
    digests = materialize(_digests(chunks), "digests")
    first = materialize(digests.groupBy("a", "b").agg(F.min("seq").alias("seq")).select("seq"), "first")
    copies = digests.select("seq").join(first, "seq", "left_anti")
    unit = _numbered(chunks, threshold)
    removed = removed_by_first_come(*_graph(unit, first, threshold, True))
    unstage(unit)
    return copies.unionByName(removed)
