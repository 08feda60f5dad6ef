"""Small building blocks for column functions."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times in ``body`` without recomputing it."""
    return F.transform(F.array(value), body)[0]


def is_empty_text(col: Column) -> Column:
    return col.isNull() | (col == "")


def is_empty_array(col: Column) -> Column:
    return col.isNull() | (F.size(col) == 0)


def all_finite(vector: Column) -> Column:
    """True when every element is finite; a missing vector passes, a null element does not."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(ok, F.lit(True))


def by_key(key: Column, cases: dict, default: Column) -> Column:
    """``when`` chain over literal keys."""
    out = None
    for name, value in cases.items():
        out = F.when(key == name, value) if out is None else out.when(key == name, value)
    return default if out is None else out.otherwise(default)


def explode_positions(df: DataFrame, array: Column, *keys: str, pos: str = "pos", value: str = "item") -> DataFrame:
    """One row per element with its zero-based position.

    A plain explode makes the optimizer test the size of the array in a filter near the scan, which computes
    an expensive array twice. The outer form with a test on the position computes it once.
    """
    return df.select(*keys, F.posexplode_outer(array).alias(pos, value)).filter(F.col(pos).isNotNull())


def in_slices(run: Callable, out: pa.DataType, *columns: pa.Array, rows: int = SLICE_ROWS) -> pa.Array:
    """``run`` over the lists of a few rows of ``columns`` at a time, as one array of type ``out``.

    Python objects take many times the bytes of an Arrow batch; this way they exist for a few rows only.
    """
    starts = range(0, len(columns[0]), rows)
    parts = [pa.array(run(*(c.slice(i, rows).to_pylist() for c in columns)), out) for i in starts]
    return pa.concat_arrays(parts) if parts else pa.array([], out)
