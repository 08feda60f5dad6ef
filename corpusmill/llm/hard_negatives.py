"""Hard negatives by exact integer inner products, several candidates to one multiplication.

Vectors become integers, ``floor(scale * x)``. Every anchor is compared with every row. The candidates' components are made
non-negative by a bias and laid side by side into fields of one wide integer per component (Kronecker packing), each field
wide enough for a whole inner product; one multiplication by an anchor's component then serves all fields, and shifts and masks
give the exact products back, less the parts that the biases added. Where two fields or more fit into the 53 exact bits of
a double, the wide integers are doubles and a matrix product sums them; wider fields are packed into Python integers.

Anchors are dealt into groups and rows into slices, both of bounded size, and each task compares one group with one slice;
what leaves a task is at most ``positives`` or ``positives * negatives`` rows an anchor. Two rounds: the nearest rows of the
same label are the positives, then the best rows of other labels between ``low`` and ``high`` percent of a positive's score.
Each anchor group is read by all slices and each slice by all groups, so moved bytes are (groups x rows + slices x anchors).

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. Of rows with the
same id, the one with the smallest (label, vector) counts. Shorter vectors count as if zeros followed; an empty one scores 0.
Components are held at +-2^k, k = 27 where the longest vector has 64 components (half a million before scaling) and half a
bit less for each doubling, so that no score passes 64 bits. Positives with a negative score have no negatives, as their band is empty. Only
the id, vector and label columns are read; others, whatever their names, have no effect. No anchors or rows: an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.session import materialize

GROUP_ROWS = 16_384  # anchors of one task
SLICE_ROWS = 65_536  # rows of one task
LEAST_SLICE = 1_024
ANCHOR_STEP = 512  # anchors and rows of one matrix product
ROW_STEP = 8_192
EXACT_BITS = 53


def limit_bits(size: int) -> int:
    """Bits of a component so that biased inner products of ``size`` components stay below 2^63."""
    return (61 - max(size - 1, 0).bit_length()) // 2


class Packed:
    """Rows packed into the fields of wide integers, ready for exact products with anchors whose components are at most ``reach``."""

    def __init__(self, rows: np.ndarray, reach: int):
        self.n, size = rows.shape
        self.reach, self.bias = reach, int(np.abs(rows).max(initial=0))
        biased = rows + self.bias
        self.sums = biased.sum(1)
        self.width = max(1, (max(size, 1) * 2 * reach * 2 * self.bias).bit_length())
        self.fields = EXACT_BITS // self.width
        if self.fields >= 2:
            biased = np.vstack([biased, np.zeros((-self.n % self.fields, size), np.int64)]).reshape(-1, self.fields, size)
            shift = (self.width * np.arange(self.fields, dtype=np.int64))[None, :, None]
            self.wide = (biased << shift).sum(1).astype(np.float64).T
        else:
            self.wide = [int.from_bytes(column.astype("<u8").tobytes(), "little") for column in biased.T]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products: one row per anchor, one column per packed row."""
        biased = anchors + self.reach
        out = np.empty((len(anchors), self.n), np.int64)
        if self.fields >= 2:
            products = (biased.astype(np.float64) @ self.wide).astype(np.int64)
            mask = (1 << self.width) - 1
            for k in range(self.fields):
                field = (products >> (self.width * k)) & mask
                out[:, k :: self.fields] = field[:, : len(range(k, self.n, self.fields))]
        else:
            for row, components in enumerate(biased.tolist()):
                total = sum(a * wide for a, wide in zip(components, self.wide))
                out[row] = np.frombuffer(total.to_bytes(8 * self.n, "little"), "<u8").astype(np.int64)
        return out - self.reach * self.sums[None, :] - (self.bias * anchors.sum(1))[:, None]


def _one(column: pa.ChunkedArray) -> pa.Array:
    """A column of a table as one array."""
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    """Integer lists as the rows of a matrix of ``size`` columns, zeros behind the shorter ones."""
    lengths = np.asarray(lists.value_lengths(), np.int64)
    out = np.zeros((len(lists), size), np.int64)
    out[np.arange(size)[None, :] < lengths[:, None]] = np.asarray(lists.flatten(), np.int64)
    return out


def _blocks(anchors: pa.Table, rows: pa.Table):
    """Scores of all anchors with all rows, a bounded block at a time: (anchor positions, row positions, scores)."""
    lists = _one(anchors["v"]), _one(rows["v"])
    size = max(1, *(int(np.asarray(x.value_lengths()).max(initial=0)) for x in lists))
    left, right = (_matrix(x, size) for x in lists)
    reach = int(np.abs(left).max(initial=0))
    for lo in range(0, len(right), ROW_STEP):
        packed = Packed(right[lo : lo + ROW_STEP], reach)
        for at in range(0, len(left), ANCHOR_STEP):
            part = left[at : at + ANCHOR_STEP]
            yield np.arange(at, at + len(part)), np.arange(lo, lo + packed.n), packed.scores(part)


def _best(scores: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties by ``rank`` (the order of the ids)."""
    found = np.arange(len(scores))
    if len(scores) > k:
        found = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return found[np.lexsort((rank[found], -scores[found]))][:k]


def _ranks(ids: pa.ChunkedArray) -> np.ndarray:
    rank = np.empty(len(ids), np.int64)
    rank[np.asarray(pc.sort_indices(ids), np.int64)] = np.arange(len(ids))
    return rank


def _codes(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Equal values of all columns as equal numbers."""
    codes = np.asarray(pa.concat_arrays([_one(c) for c in columns]).dictionary_encode().indices)
    ends = np.cumsum([len(c) for c in columns])
    return np.split(codes, ends[:-1])


def _nearest(positives: int, schema: pa.Schema):
    """Task: the best rows of the same label for each anchor of a group within one slice."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return schema.empty_table()
        rank, (a_label, r_label), (a_id, r_id) = _ranks(rows["id"]), _codes(anchors["label"], rows["label"]), _codes(anchors["id"], rows["id"])
        who, what, score = [], [], []
        for at, lo, scores in _blocks(anchors, rows):
            for k, i in enumerate(at):
                same = np.flatnonzero((r_label[lo] == a_label[i]) & (r_id[lo] != a_id[i]))
                top = same[_best(scores[k][same], rank[lo][same], positives)]
                who.append(np.full(len(top), i))
                what.append(lo[top])
                score.append(scores[k][top])
        who, what = np.concatenate(who), np.concatenate(what)
        return pa.Table.from_arrays([anchors["id"].take(pa.array(who)), rows["id"].take(pa.array(what)), pa.array(np.concatenate(score))], schema=schema)

    return run


def _hardest(negatives: int, low: int, high: int, schema: pa.Schema):
    """Task: for each anchor and positive, the best rows of other labels inside the positive's band within one slice."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return schema.empty_table()
        rank, (a_label, r_label) = _ranks(rows["id"]), _codes(anchors["label"], rows["label"])
        goals = anchors["positive_scores"].to_pylist()
        # The band in whole scores: low * p <= 100 * s <= high * p.
        bands = [[(-(-low * p // 100), high * p // 100) for p in ps] for ps in goals]
        who, which, what, score = [], [], [], []
        for at, lo, scores in _blocks(anchors, rows):
            for k, i in enumerate(at):
                if not bands[i]:
                    continue
                inside = (scores[k] >= min(b[0] for b in bands[i])) & (scores[k] <= max(b[1] for b in bands[i]))
                near = np.flatnonzero(inside & (r_label[lo] != a_label[i]))
                own, order = scores[k][near], rank[lo][near]
                for p, (least, most) in enumerate(bands[i]):
                    fit = np.flatnonzero((own >= least) & (own <= most))
                    top = fit[_best(own[fit], order[fit], negatives)]
                    who.append(np.full(len(top), i))
                    which.append(np.full(len(top), p))
                    what.append(lo[near[top]])
                    score.append(own[top])
        if not who:
            return schema.empty_table()
        who, what = np.concatenate(who), np.concatenate(what)
        return pa.Table.from_arrays(
            [anchors["id"].take(pa.array(who)), pa.array(np.concatenate(which).astype(np.int32)), rows["id"].take(pa.array(what)), pa.array(np.concatenate(score))],
            schema=schema,
        )

    return run


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = 256) -> DataFrame:
    """The rows that take part, one per id: ``id``, ``label``, ``v`` (integers)."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    most = F.lit(float(2 ** limit_bits(longest or 1)))
    whole = F.transform("v", lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), most), -most).cast("int"))
    kept = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    one = kept.select("id", F.struct("label", whole.alias("v")).alias("row")).groupBy("id").agg(F.min("row").alias("row"))
    return one.select("id", "row.label", "row.v")


def _slices(n_rows: int, n_groups: int, slots: int) -> int:
    """Slices of bounded size, more where that would leave task slots idle, none smaller than ``LEAST_SLICE`` rows."""
    wanted = max(-(-n_rows // SLICE_ROWS), -(-2 * slots // n_groups))
    return max(1, min(wanted, -(-n_rows // LEAST_SLICE)))


def _compare(anchors: DataFrame, rows: DataFrame, n_groups: int, n_slices: int, task, schema: T.StructType) -> DataFrame:
    """Every group of anchors with every slice of rows, one pair to a task."""
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # New column identities: both sides come from one table.
    left = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    left = left.withColumn("g", deal(n_groups)).withColumn("s", every(n_slices))
    right = rows.withColumn("s", deal(n_slices)).withColumn("g", every(n_groups))
    return left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(task, schema)


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, both scores.

    ``is_anchor`` is a condition on the column ``id``, which is what the id column is called inside. Positives are the first ``positives``
    other rows of the anchor's label by score (ties: smaller id), negatives the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = vectors.sparkSession
    rows = materialize(integer_vectors(vectors, id_col, vector_col, label_col, scale), "vectors")
    anchors = rows.filter(is_anchor)
    n_rows, n_anchors = rows.count(), anchors.count()
    n_groups = max(1, -(-n_anchors // GROUP_ROWS))
    n_slices = _slices(n_rows, n_groups, spark.sparkContext.defaultParallelism)
    id_type = rows.schema["id"].dataType

    near = T.StructType([T.StructField("anchor_id", id_type), T.StructField("positive_id", id_type), T.StructField("positive_score", T.LongType())])
    found = _compare(anchors, rows.select("id", "label", "v"), n_groups, n_slices, _nearest(positives, to_arrow_schema(near)), near)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    nearest = materialize(found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives), "positives")

    lists = nearest.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    goals = anchors.join(lists.select("id", F.col("p.positive_score").alias("positive_scores")), "id")
    hard = T.StructType([
        T.StructField("anchor_id", id_type), T.StructField("place", T.IntegerType()), T.StructField("negative_id", id_type), T.StructField("negative_score", T.LongType())
    ])
    found = _compare(goals, rows, n_groups, n_slices, _hardest(negatives, low, high, to_arrow_schema(hard)), hard)
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives).withColumn("place", F.col("place") + 1)
    return ranked.join(nearest, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
