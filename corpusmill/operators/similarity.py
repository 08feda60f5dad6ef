"""Exact cosine near-duplicates by pivots, bounded blocks and matrix products inside tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import EMBEDDING_THRESHOLD
from corpusmill.operators.resolver import removed_by_first_come
from corpusmill.operators.terms import terms_removed
from corpusmill.functions.common import all_finite
from corpusmill.session import materialize

MAX_PIVOTS = 512
BLOCK_ROWS = 16384
TILE_ROWS = 512
TILE_COLUMNS = 4096
PART_ROWS = 512
ROUTED_ROWS = 8192
PAIR_ROWS = 1 << 16
SLACK = 1e-6
_PAIR_DDL = "lo bigint, hi bigint, cosine double"
_PAIR_ARROW = pa.schema([("lo", pa.int64()), ("hi", pa.int64()), ("cosine", pa.float64())])


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _matrix(column) -> np.ndarray:
    """Unit rows of an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten(), dtype=np.float64)
    return _unit(values.reshape(len(column), -1))


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def _pivots(vectors: DataFrame, wanted: int, apart: float) -> np.ndarray:
    """A bounded sample, thinned until all pivots are more than ``apart`` from each other.

    Thinning makes a tight ball of copies fall to one pivot instead of being split between several.
    """
    sample = vectors.orderBy(F.xxhash64("seq")).limit(min(4 * wanted, 4 * MAX_PIVOTS)).collect()
    if not sample:
        return np.zeros((0, 1))
    rows = _unit(np.array([r["embedding"] for r in sample], dtype=np.float64))
    chosen = rows[:1]
    for row in rows[1:]:
        if len(chosen) >= wanted:
            break
        if _angles(row[None, :], chosen).min() > apart:
            chosen = np.vstack([chosen, row])
    return chosen


def _parts(batches, rows: int):
    """Batches of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _assign(pivots: np.ndarray, clique_radius: float):
    """Add the nearest pivot's angle and the unit: 2·pivot for clique members, 2·pivot + 1 for others."""

    def run(batches):
        for batch in _parts(batches, PART_ROWS):
            angles = _angles(_matrix(batch.column("embedding")), pivots)
            nearest = angles.argmin(axis=1)
            angle = angles[np.arange(len(nearest)), nearest]
            unit = 2 * nearest + (angle > clique_radius)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(unit, pa.int64()), pa.array(angle)],
                names=[*batch.schema.names, "unit", "angle"],
            )

    return run


def _route(pivots: np.ndarray, radius: dict[int, float], splits: dict[int, int], reach: float):
    """Copies of each vector for all unit pairs in which it may have a partner.

    A partner y of x in unit q satisfies angle(x, pivot) <= angle(x, y) + angle(y, pivot) <= reach + radius,
    so units farther away are skipped without losing a pair. Members of a clique are not compared with each
    other.
    """
    units = np.array(sorted(radius), dtype=np.int64)
    limits = np.array([radius[u] for u in units]) + reach + SLACK
    counts = np.array([splits[u] for u in units], dtype=np.int64)
    # A row may go to every block, so a batch that is sent on has a bounded number of copies however many blocks there are.
    most = max(1, ROUTED_ROWS // max(1, int(counts.sum())))

    def run(batches):
        for batch in _parts(batches, most):
            possible = _angles(_matrix(batch.column("embedding")), pivots[units // 2]) <= limits
            own = batch.column("unit").to_numpy()
            place = np.searchsorted(units, own)
            possible[np.arange(len(own)), place] &= own % 2 == 1
            rows, cols = np.nonzero(possible)
            times = counts[cols]
            rows, cols = np.repeat(rows, times), np.repeat(cols, times)
            part = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
            mine = (own << 32) + batch.column("spot").to_numpy() % counts[place]
            here, there = mine[rows], (units[cols] << 32) + part
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.minimum(here, there)),
                    pa.array(np.maximum(here, there)),
                    pa.array(here),
                    batch.column("seq").take(taken),
                    batch.column("embedding").take(taken),
                ],
                names=["a", "b", "block", "seq", "embedding"],
            )

    return run


def _compare(threshold: float):
    """Pairs of one block pair, tile by tile: a task holds two blocks and the pairs of one tile."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (k.as_py() for k in key)
        parts = [(p.column("block").to_numpy(), p.column("seq").to_numpy(), _matrix(p.column("embedding"))) for p in batches]
        block, seq, rows = (np.concatenate(x) for x in zip(*parts))
        del parts
        left, right = np.nonzero(block == a)[0], np.nonzero(block == b)[0]
        for start in range(0, len(left), TILE_ROWS):
            tile = left[start : start + TILE_ROWS]
            for at in range(0, len(right), TILE_COLUMNS):
                other = right[at : at + TILE_COLUMNS]
                sims = rows[tile] @ rows[other].T
                i, j = np.nonzero(sims >= threshold)
                s, t, sim = seq[tile[i]], seq[other[j]], sims[i, j]
                if a == b:
                    once = s < t
                    s, t, sim = s[once], t[once], sim[once]
                for lo in range(0, len(s), PAIR_ROWS):
                    x, y = s[lo : lo + PAIR_ROWS], t[lo : lo + PAIR_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(sim[lo : lo + PAIR_ROWS])], schema=_PAIR_ARROW
                    )

    return run


def _nonzero(vectors: DataFrame) -> DataFrame:
    """Vectors that can be similar to something: no null, NaN or infinite element, and not all zero."""
    return vectors.filter(F.exists("embedding", lambda x: x != 0) & all_finite(F.col("embedding")))


def cosine_graph(
    vectors: DataFrame,
    threshold: float = EMBEDDING_THRESHOLD,
    block_rows: int = BLOCK_ROWS,
    pivots: int | None = None,
    with_cliques: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """Pairs (``lo``, ``hi``, ``cosine``) with cosine >= threshold, and the cliques whose inner pairs are left out.

    ``vectors`` has ``seq`` and ``embedding`` (one length, no zero vectors). The method is exact:

    * each vector goes to its nearest pivot; those within half the threshold angle form a clique, since any
      two of them are within the threshold. Clique pairs are implied and never listed, so one group holding
      a third of the table costs rows, not pairs;
    * units are cut into blocks of about ``block_rows`` rows and only block pairs that the triangle
      inequality cannot exclude are compared, each as matrix products of bounded size.

    Work beyond the cliques is quadratic only among units that lie close together. Vectors without any
    cluster structure leave nothing to exclude; for those the cost is that of all block pairs.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("seq", "embedding")
    total = vectors.count()
    reach = math.acos(max(-1.0, min(1.0, threshold)))
    wanted = pivots or max(1, min(MAX_PIVOTS, math.ceil(total / block_rows)))
    centers = _pivots(vectors, wanted, reach / 2)
    if not len(centers):
        cliques = spark.createDataFrame([], "clique bigint, seq bigint") if with_cliques else None
        return spark.createDataFrame([], _PAIR_DDL), cliques
    placed = vectors.withColumn("spot", F.pmod(F.xxhash64("seq"), F.lit(1 << 31))).mapInArrow(
        _assign(centers, reach / 2 - SLACK if with_cliques else -1.0),
        "seq bigint, embedding array<float>, spot bigint, unit bigint, angle double",
    )
    placed = materialize(placed, "placed")
    # At most two rows per pivot reach the driver.
    stats = placed.groupBy("unit").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("rows")).collect()
    radius = {r["unit"]: r["radius"] for r in stats}
    splits = {r["unit"]: math.ceil(r["rows"] / block_rows) for r in stats}
    routed = placed.select("seq", "embedding", "spot", "unit").mapInArrow(
        _route(centers, radius, splits, reach),
        "a bigint, b bigint, block bigint, seq bigint, embedding array<float>",
    )
    pairs = routed.groupBy("a", "b").applyInArrow(_compare(threshold), _PAIR_DDL)
    if not with_cliques:
        return pairs, None
    return pairs, placed.filter(F.col("unit") % 2 == 0).select(F.col("unit").alias("clique"), "seq")


def cosine_pairs(vectors: DataFrame, threshold: float = EMBEDDING_THRESHOLD, **options) -> DataFrame:
    """All pairs ``lo < hi`` with cosine >= threshold; the output itself may be quadratic."""
    return cosine_graph(_nonzero(vectors), threshold, with_cliques=False, **options)[0]


def embedding_removed(vectors: DataFrame, threshold: float = EMBEDDING_THRESHOLD, **options) -> DataFrame:
    """Order numbers removed by the first-come rule. Zero or missing vectors are never duplicates.

    Identical vectors are folded to their first row beforehand, which leaves the result unchanged.
    """
    vectors = _nonzero(vectors.select("seq", "embedding"))
    first = vectors.groupBy("embedding").agg(F.min("seq").alias("seq"))
    first = materialize(first.select("seq", "embedding"), "vectors")
    copies = vectors.select("seq").join(first.select("seq"), "seq", "left_anti")
    pairs, cliques = cosine_graph(first, threshold, **options)
    return copies.unionByName(removed_by_first_come(pairs, cliques))


def deduplicate_by_embedding(
    records: DataFrame,
    threshold: float = EMBEDDING_THRESHOLD,
    seq: str = "seq",
    embedding: str = "content_embedding",
    **options,
) -> tuple[DataFrame, DataFrame]:
    """``records`` without later near copies, and the removed order numbers; sparse vectors where there is a column of their terms."""
    if f"{embedding}_terms" in records.columns:
        vectors = records.select(F.col(seq).alias("seq"), F.col(f"{embedding}_terms").alias("terms"), F.col(embedding).alias("weights"))
        removed = terms_removed(vectors, threshold).withColumnRenamed("seq", seq)
    else:
        vectors = records.select(F.col(seq).alias("seq"), F.col(embedding).alias("embedding"))
        removed = embedding_removed(vectors, threshold, **options).withColumnRenamed("seq", seq)
    return records.join(removed, seq, "left_anti"), removed
