"""Streaming forms of record building, progress and alerts. Inputs are streaming DataFrames.

Timestamps without zone must be cast to ``timestamp`` before a watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.categories import work_grid
from corpusmill.operators.quality import long_enough, save_reasons
from corpusmill.operators.stats import progress
from corpusmill.operators.summaries import summarize
from corpusmill.plans.records import clean_pages, derive_records
from corpusmill.sinks.writers import remove, write_progress


AVAILABLE = {"availableNow": True}


def run_available(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", schema: str | None = None, trigger: dict | None = None
) -> DataFrame:
    """Process everything available into parquet files and return the written table; ``trigger`` as in :func:`run_batches`."""
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE)).start()
    )
    _finished(query, trigger)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_batches(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Call ``write`` for every micro-batch: of what is available, or with another ``trigger`` (the arguments of Spark's
    ``trigger``, such as ``{"processingTime": "1 minute"}``) for as long as the returned query is not stopped."""
    query = (
        stream.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE)).start()
    )
    _finished(query, trigger)
    return query


def _finished(query: StreamingQuery, trigger: dict | None) -> None:
    """Wait for queries that end by themselves; others run on."""
    if trigger is None or {"availableNow", "once"} & trigger.keys():
        query.awaitTermination()


def record_stream(
    pages: DataFrame, path: str, checkpoint: str, stop_words: dict[str, Iterable[str]], idf: np.ndarray, trigger: dict | None = None
) -> StreamingQuery:
    """Page texts to ``records`` and ``rejects`` below ``path``.

    Each micro-batch writes its own directories by batch id, so a repeated batch replaces itself: no loss, no
    duplicates. Records that break a save rule go to ``rejects`` with their reasons, pages that are too short with the reason ``content``,
    so that every page is in one of the two. ``idf`` is a fixed term-weight vector fitted on an earlier batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        records = derive_records(summarize(clean_pages(batch, drop_short=False), idf=idf), stop_words)
        for name in ("content_embedding", "summary_embedding"):
            records = records.withColumn(name, F.lit(None).cast("array<float>"))
        short = F.array_compact(F.array(F.when(~F.coalesce(long_enough(F.col("content")), F.lit(False)), "content")))
        # Staged as a table: its splits are bounded, where a cached partition grows with the texts of a whole input split.
        marked = records.withColumn("reasons", F.concat(short, save_reasons()))
        staged = f"{path}/_staged-{batch_id}"
        marked.write.mode("overwrite").parquet(staged)
        marked = batch.sparkSession.read.schema(marked.schema).parquet(staged)
        good, bad = marked.filter(F.size("reasons") == 0), marked.filter(F.size("reasons") > 0)
        good.drop("reasons").write.mode("overwrite").parquet(f"{path}/records/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{path}/rejects/batch={batch_id}")
        remove(batch.sparkSession, staged)

    return run_batches(pages, checkpoint, write, trigger=trigger)


def progress_stream(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Replace the progress snapshot at ``path`` after every micro-batch."""
    return run_batches(progress(records), checkpoint, lambda batch, _: write_progress(batch, path), "complete", trigger)


def error_rates(
    events: DataFrame, success: Column, error: Column, width: str, slide: str, delay: str | None = None, ts: str = "ts"
) -> DataFrame:
    """(window_start, window_end, errors, successes, error_rate); batch, or stream with a watermark ``delay``."""
    if delay is not None:
        events = events.withWatermark(ts, delay)
    return (
        events.groupBy(F.window(ts, width, slide))
        .agg(
            F.count(F.when(error, 1)).alias("errors"),
            F.count(F.when(success, 1)).alias("successes"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "errors",
            "successes",
            F.coalesce(F.try_divide("errors", F.col("errors") + F.col("successes")), F.lit(0.0)).alias("error_rate"),
        )
    )


def held_alerts(breaches: DataFrame, slide_seconds: int, hold_seconds: int, at: str = "window_end") -> DataFrame:
    """Times at which a condition has held for the whole ``hold_seconds`` up to then.

    Each breach supports itself and the following steps within the hold; a time with full support fires. This
    is one partial aggregate instead of a window over all rows in one task.
    """
    steps = hold_seconds // slide_seconds
    supported = breaches.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(steps)),
                lambda i: F.timestamp_seconds(F.unix_seconds(F.col(at)) + i * slide_seconds),
            )
        ).alias("fired_at")
    )
    return supported.groupBy("fired_at").agg(F.count(F.lit(1)).alias("support")).filter(
        F.col("support") == steps + 1
    ).select("fired_at")


def error_rate_alerts(rates: DataFrame, slide_seconds: int, hold_seconds: int, limit: float = 0.2) -> DataFrame:
    """Alert times from :func:`error_rates` output; a window without events does not fire."""
    return held_alerts(rates.filter(F.col("error_rate") > limit), slide_seconds, hold_seconds)


def heartbeat_grid(events: DataFrame, slide_seconds: int, ts: str = "ts") -> DataFrame:
    """(beat): regular times spanning the events, so that windows without rows exist."""
    bounds = events.agg(F.min(ts).alias("a"), F.max(ts).alias("b"))

    def floor(c: Column) -> Column:
        return F.floor(F.unix_seconds(c) / slide_seconds) * slide_seconds

    steps = F.sequence(floor(F.col("a")), floor(F.col("b")), F.lit(slide_seconds).cast("bigint"))
    return bounds.filter("a IS NOT NULL").select(F.explode(steps).alias("s")).select(F.timestamp_seconds("s").alias("beat"))


def success_counts(
    events: DataFrame, beats: DataFrame, success: Column, width: str, slide: str,
    delay: str | None = None, ts: str = "ts",
) -> DataFrame:
    """(window_start, window_end, successes) with heartbeat rows filling windows that have no event."""
    marked = events.select(F.col(ts).alias("at"), F.when(success, 1).otherwise(0).alias("ok"))
    union = marked.unionByName(beats.select(F.col("beat").alias("at"), F.lit(0).alias("ok")))
    if delay is not None:
        union = union.withWatermark("at", delay)
    return (
        union.groupBy(F.window("at", width, slide))
        .agg(F.sum("ok").alias("successes"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "successes"
        )
    )


def stall_alerts(counts: DataFrame, slide_seconds: int, hold_seconds: int) -> DataFrame:
    return held_alerts(counts.filter("successes = 0"), slide_seconds, hold_seconds)


def first_seen(stream: DataFrame, keys: list[str], delay: str, ts: str = "ts") -> DataFrame:
    """First row per key with bounded state: a repeat that comes later than ``delay`` passes again."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def mean_durations(events: DataFrame, value: str, width: str, delay: str | None = None, ts: str = "ts") -> DataFrame:
    """(window_start, n, seconds, mean_seconds) per tumbling window."""
    if delay is not None:
        events = events.withWatermark(ts, delay)
    return (
        events.groupBy(F.window(ts, width))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("seconds"), F.avg(value).alias("mean_seconds"))
        .select(F.col("window.start").alias("window_start"), "n", "seconds", "mean_seconds")
    )


def job_stream(jobs: DataFrame, **options) -> DataFrame:
    """Work rows of a stream of jobs."""
    return work_grid(jobs, **options)


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json", glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
