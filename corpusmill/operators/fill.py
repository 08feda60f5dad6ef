"""Filling gaps from side tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["title", "language"]


def is_empty(col: Column, dtype: T.DataType) -> Column:
    """Missing, '' and [] are empty; zero, false and {} are not."""
    if isinstance(dtype, T.StringType):
        return col.isNull() | (col == "")
    if isinstance(dtype, T.ArrayType):
        return col.isNull() | (F.size(col) == 0)
    return col.isNull()


def _filled(ours: Column, theirs: Column, dtype: T.DataType) -> Column:
    return F.when(is_empty(ours, dtype), F.coalesce(theirs, ours)).otherwise(ours)


def complete_missing_fields(records: DataFrame, extra: DataFrame, order: str = "extra_seq") -> DataFrame:
    """Left join on (title, language), missing keys matching each other; the last extra row per key wins.

    Empty fields take the extra value, columns we lack are added, and the ``metadata`` struct is merged field
    by field (missing on both sides, it stays so). Extra rows are folded by partial aggregation before the join.
    """
    columns = [c for c in extra.columns if c not in (*KEYS, order)]
    last = extra.groupBy(*KEYS).agg(F.max_by(F.struct(*columns), order).alias("more"))
    last = last.select(*[F.col(k).alias(f"more_{k}") for k in KEYS], "more")
    on = [F.col(k).eqNullSafe(F.col(f"more_{k}")) for k in KEYS]
    joined = records.join(last, on, "left")
    types = {f.name: f.dataType for f in records.schema.fields}
    more_types = {f.name: f.dataType for f in extra.schema.fields}
    out = []
    for name, dtype in types.items():
        if name not in columns:
            out.append(F.col(name))
        elif name == "metadata" and isinstance(dtype, T.StructType):
            out.append(_merge_struct(F.col(name), F.col("more.metadata"), dtype, more_types[name]).alias(name))
        else:
            out.append(_filled(F.col(name), F.col(f"more.{name}"), dtype).alias(name))
    out += [F.col(f"more.{name}").alias(name) for name in columns if name not in types]
    return joined.select(*out)


def _merge_struct(ours: Column, theirs: Column, dtype: T.StructType, more: T.StructType) -> Column:
    more_names = set(more.fieldNames())
    fields = []
    for f in dtype.fields:
        value = ours[f.name]
        if f.name in more_names:
            value = _filled(value, theirs[f.name], f.dataType)
        fields.append(value.alias(f.name))
    fields += [theirs[n].alias(n) for n in more.fieldNames() if n not in dtype.fieldNames()]
    return F.when(ours.isNotNull() | theirs.isNotNull(), F.struct(*fields))


def attach_metadata(records: DataFrame, extra: DataFrame, key: str = "id") -> DataFrame:
    """Copy ``wikidata_id`` and ``image_url`` from ``extra`` where given; of several rows of a key the largest value counts."""
    names = [c for c in ("wikidata_id", "image_url") if c in extra.columns]
    side = extra.groupBy(key).agg(*[F.max(c).alias(f"given_{c}") for c in names]) if names else extra.select(key).distinct()
    joined = records.join(side, key, "left")
    for name in names:
        ours = F.col(name) if name in records.columns else F.lit(None).cast("string")
        joined = joined.withColumn(name, F.coalesce(F.col(f"given_{name}"), ours))
    return joined.drop(*[f"given_{c}" for c in names])


def last_good(requests: DataFrame, snapshots: DataFrame, now: Column | str) -> DataFrame:
    """Fresh value, else the newest stored one that has not expired, else ''.

    ``requests``: ``key``, ``fresh`` (null when the fetch failed). ``snapshots``: ``key``, ``value``,
    ``fetched_at``, ``expires_at`` (null = never).
    """
    newest = unexpired(snapshots, now).groupBy("key").agg(F.max_by("value", "fetched_at").alias("stored"))
    joined = requests.join(newest, "key", "left")
    return joined.withColumn("value", F.coalesce("fresh", "stored", F.lit(""))).drop("fresh", "stored")


def unexpired(snapshots: DataFrame, now: Column | str) -> DataFrame:
    """Purge: rows whose expiry is missing or not before ``now``."""
    now = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    return snapshots.filter(F.col("expires_at").isNull() | (F.col("expires_at") >= now))
