"""Streaming forms of the sketch and the cohort (user-level jobs).

* :func:`stream_sketches`: keep a sketch table current from a stream.  Every
  micro-batch is reduced to one small sketch per group and written to its
  own ``batch_id=<n>`` partition of the table, with overwrite, so a replayed
  batch (after a failure) replaces its own output instead of adding to it.
  :func:`read_stream_sketches` merges all batches; :func:`compact_sketches`
  rewrites them as one merged snapshot when the batch count grows.
* :func:`stream_cohort_exact`: the exact cohort per event-time window with a
  watermark (late rows beyond it are dropped, as in any watermarked stream).
  Two chained stateful aggregations in append mode: a window is emitted once
  the watermark passes its end.

Sketch building uses ``row_number``, which Spark does not allow on a stream,
so it runs per micro-batch inside ``foreachBatch``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import TupleExpr, predicate_on
from ..functions.metrics import ColumnOrName, Metric, check_metrics
from ..operators.build import DEFAULT_K, tuple_sketch
from ..operators.merge import merge_sketches
from ..operators.rows import KEY, group_columns, prepared
from ..sources.store import read_sketches

BATCH_COL = "batch_id"


def stream_sketches(stream: DataFrame, path: str, key: ColumnOrName, metrics: Sequence[Metric],
                    by: Sequence[ColumnOrName] | ColumnOrName | None = None,
                    k: int = DEFAULT_K, hash: str = "md5",
                    checkpoint_location: str | None = None,
                    trigger: dict | None = None) -> StreamingQuery:
    """Start a query writing per-batch sketches under ``path`` (see module doc).

    ``trigger``: keyword arguments for ``DataStreamWriter.trigger``, e.g.
    ``{"availableNow": True}`` or ``{"processingTime": "1 minute"}``."""
    metrics = check_metrics(metrics)
    # Beside the batches (Spark's readers skip it), so a restart on a path goes on where it stopped.
    ckpt = checkpoint_location or f"{path.rstrip('/')}/_checkpoint"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch_sketches(batch, batch_id, path, key, metrics, by=by, k=k, hash=hash)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_batch_sketches(batch: DataFrame, batch_id: int, path: str, key: ColumnOrName,
                         metrics: Sequence[Metric],
                         by: Sequence[ColumnOrName] | ColumnOrName | None = None,
                         k: int = DEFAULT_K, hash: str = "md5") -> None:
    """Sketch one micro-batch into ``path/batch_id=<n>`` (overwrite: replay-safe)."""
    sk = tuple_sketch(batch, key, metrics, by=by, k=k, hash=hash)
    sk.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH_COL}={batch_id}")


def read_stream_sketches(spark: SparkSession, path: str, by: Sequence[str] | str | None = None,
                         k: int = DEFAULT_K, num_values: int = 1,
                         sketch: str = "sketch", snapshot: str | None = None) -> DataFrame:
    """Current sketches: all per-batch sketches merged per group.

    ``snapshot``: a folder written by :func:`compact_sketches`; only batches after it are read."""
    stored = read_sketches(spark, path, sketch)
    if snapshot is not None:
        base = read_sketches(spark, snapshot, sketch)
        through = base.agg(F.max(BATCH_COL)).first()[0]   # a partition column: one value a snapshot
        if through is not None:
            later = stored.where(F.col(BATCH_COL) > through)   # prunes the folders of older batches
            stored = base.unionByName(later)
    return merge_sketches(stored, sketch, by=group_columns(by), k=k, num_values=num_values)


def compact_sketches(spark: SparkSession, path: str, out_path: str,
                     by: Sequence[str] | str | None = None, k: int = DEFAULT_K,
                     num_values: int = 1, snapshot: str | None = None) -> DataFrame:
    """Write the merged state to ``out_path`` (a new location) as a snapshot through the last batch.

    ``snapshot``: an earlier snapshot to start from, so that only later batches are merged.
    Batch folders stay valid; readers pass the new snapshot when they switch over."""
    through = read_sketches(spark, path).agg(F.max(BATCH_COL)).first()[0]
    merged = read_stream_sketches(spark, path, by=by, k=k, num_values=num_values, snapshot=snapshot)
    if through is None:
        through = -1
    merged.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/{BATCH_COL}={through}")
    return read_sketches(spark, out_path)


def _event_time(stream: DataFrame, ts: ColumnOrName) -> tuple[Column, str]:
    """Event time as a TIMESTAMP, plus the zone its wall clock is read in.

    A ``TIMESTAMP_NTZ`` value becomes the instant whose UTC wall clock equals
    it, so windows (aligned in UTC) follow its calendar under any session
    time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    dt = stream.select(c).schema.fields[0].dataType
    if isinstance(dt, T.TimestampNTZType):
        # Field by field, so no daylight-saving rule of any zone is involved.
        utc = F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                               F.date_part(F.lit("SECOND"), c), F.lit("UTC"))
        return utc, "UTC"
    return c.cast("timestamp"), "session"


def stream_cohort_exact(stream: DataFrame, ts: str, key: ColumnOrName,
                        metrics: Sequence[Metric], cond: TupleExpr,
                        window: str = "7 days", start_offset: str = "4 days",
                        watermark: str = "1 day", name: str = "keys") -> DataFrame:
    """Streaming ``bucket DATE, name BIGINT``: exact cohort size per window.

    The default window is the ISO week (epoch day 0 is a Thursday, hence the
    4-day offset).  Windows are aligned in UTC; a ``TIMESTAMP_NTZ`` event time
    is bucketed by its own calendar whatever the session time zone."""
    metrics = check_metrics(metrics)
    et, wall_zone = _event_time(stream, ts)
    s = stream.withColumn("__tc_et", et).withWatermark("__tc_et", watermark)
    # The batch rules for nulls, empty keys and multi-valued keys.
    s = prepared(s, ["__tc_et"], key, metrics, keep_invalid=False)
    per_key = s.groupBy(F.window("__tc_et", window, window, start_offset).alias("__tc_w"), KEY).agg(
        *[F.sum(f"__tc_m{i}").alias(f"__tc_s{i}") for i in range(len(metrics))])
    per_key = per_key.withColumn("__tc_values", F.array(*[F.col(f"__tc_s{i}") for i in range(len(metrics))]))
    counted = per_key.groupBy("__tc_w").agg(F.count_if(predicate_on("__tc_values", cond)).alias(name))
    start = F.col("__tc_w")["start"]
    if wall_zone == "UTC":  # the window's UTC calendar date, from epoch seconds
        bucket = F.date_from_unix_date(F.floor(F.unix_seconds(start) / 86400).cast("int"))
    else:
        bucket = F.to_date(start)
    return counted.select(bucket.alias("bucket"), name)
