"""Sketches of a stream kept in tiers, and over a sliding window.

* :class:`TieredSketches`: ``fan`` runs of a tier become one of the next, so after n batches there are at most
  ``(fan - 1) * (log_fan(n) + 1)`` folders, a batch's entries are rewritten log_fan(n) times, and the current sketch
  merges some tens of folders instead of n.  :func:`stream_tiered` fills one from a stream.
* :class:`SlidingSketches`: the last ``window`` periods.  A sketch cannot be subtracted, so expired periods must never
  have been merged with live ones that stay: periods are cut into blocks of ``window``; a finished block is kept as
  merges of its last 1, 2, ... periods (suffixes), the open one as one merge from its start (prefix).  Any window is
  one suffix and one prefix: two folders, and about three small merges a period.

Both name their folders in a :class:`~tuplecohort.sources.manifest.Manifest`: a crash between writing and the swap leaves
the old state, and the replayed batch does its work again.  A batch (period) that the state already has is skipped, so
replays count once.  Merging is associative: the result is that of merging all batches at once.

Defined cases: batches may be empty (their number counts, their rows do not) and numbers may be left out; a number below
the last one is a replay; reading before the first batch raises; null sketches count as empty.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.metrics import ColumnOrName, Metric, check_metrics
from ..operators.build import DEFAULT_K, tuple_sketch
from ..operators.merge import merge_sketches
from ..sources.manifest import Manifest, Run
from ..sources.store import as_sketch_column


class _Kept:
    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], k: int, num_values: int, sketch: str):
        self.spark, self.path, self.by = spark, path, list(by)
        self.k, self.num_values, self.sketch = k, num_values, sketch
        self.manifest = Manifest(spark, path)

    def _prepared(self, sketches: DataFrame) -> DataFrame:
        return as_sketch_column(sketches, self.sketch).select(*self.by, self.sketch)

    def _merge(self, df: DataFrame) -> DataFrame:
        return merge_sketches(df, self.sketch, by=self.by, k=self.k, num_values=self.num_values)

    def vacuum(self) -> int:
        """Delete folders that no kept version names (what crashes and old versions left)."""
        return self.manifest.vacuum()


class TieredSketches(_Kept):
    """Sketches of all batches, in tiers (see the module)."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = (), k: int = DEFAULT_K, num_values: int = 1,
                 fan: int = 4, sketch: str = "sketch"):
        super().__init__(spark, path, by, k, num_values, sketch)
        if fan < 2:
            raise ValueError("fan must be 2 or more")
        self.fan = fan

    def add(self, sketches: DataFrame, batch_id: int) -> None:
        """Add the sketches of batch ``batch_id`` (higher than any before; else it is a replay and skipped)."""
        version, runs = self.manifest.latest()
        if runs and batch_id <= runs[-1].last:
            return
        sketches = self._prepared(sketches)
        new = self.manifest.write(sketches, "batch", 0, batch_id, batch_id)
        runs = runs + [new]
        # All tiers that fill up are merged in one job: the runs that end up together, from the lowest tier on.
        level, start = 0, len(runs) - 1
        while (n := sum(r.level == level for r in runs[:start])) == self.fan - 1:
            start, level = start - n, level + 1
        if level:
            old = runs[start:]
            merged = self._merge(self.manifest.read(old, sketches.schema))
            runs = runs[:start] + [self.manifest.write(merged, "tier", level, old[0].first, batch_id)]
        self.manifest.commit(version, runs, sketches.schema)

    def merged(self) -> DataFrame:
        """``by..., sketch``: the current sketch of every group."""
        return self._merge(self.manifest.read(self.manifest.latest()[1]))


def stream_tiered(stream: DataFrame, tiers: TieredSketches, key: ColumnOrName, metrics: Sequence[Metric],
                  by: Sequence[ColumnOrName] | ColumnOrName | None = None, hash: str = "md5",
                  checkpoint_location: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start a query that adds a sketch of every micro-batch to ``tiers``; ``by`` must yield its group columns."""
    metrics = check_metrics(metrics)

    def add(batch: DataFrame, batch_id: int) -> None:
        tiers.add(tuple_sketch(batch, key, metrics, by=by, k=tiers.k, hash=hash), batch_id)

    w = stream.writeStream.foreachBatch(add).option("checkpointLocation",
                                                    checkpoint_location or f"{tiers.path.rstrip('/')}/_checkpoint")
    return (w.trigger(**trigger) if trigger else w).start()


class SlidingSketches(_Kept):
    """Sketches of the last ``window`` periods (days, weeks: numbered by the caller), as two stacks (see the module)."""

    def __init__(self, spark: SparkSession, path: str, window: int, by: Sequence[str] = (), k: int = DEFAULT_K,
                 num_values: int = 1, sketch: str = "sketch"):
        super().__init__(spark, path, by, k, num_values, sketch)
        if window < 1:
            raise ValueError("window must be 1 or more")
        self.span = window

    def add(self, sketches: DataFrame, period: int) -> None:
        """Add the sketches of ``period`` (higher than any before; else it is a replay and skipped)."""
        version, runs = self.manifest.latest()
        days = [r for r in runs if r.kind == "period"]
        if days and period <= days[-1].last:
            return
        sketches = self._prepared(sketches)
        suffixes = [r for r in runs if r.kind == "suffix"]
        prefix = [r for r in runs if r.kind == "prefix"]
        if days and days[-1].last // self.span != period // self.span:
            block = days[-1].last // self.span
            suffixes = self._suffixes(days, sketches.schema) if block + 1 == period // self.span else []
            days, prefix = [], []
        new = self.manifest.write(sketches, "period", 0, period, period)
        both = self._merge(self.manifest.read([*prefix, new], sketches.schema))
        prefix = [self.manifest.write(both, "prefix", 0, (prefix or [new])[0].first, period)]
        live = [r for r in suffixes if r.first > period - self.span]
        self.manifest.commit(version, [*live, *prefix, *days, new], sketches.schema)

    def _suffixes(self, days: list[Run], schema) -> list[Run]:
        """Merges of the last 1, 2, ... periods of a finished block, each from the one before."""
        found: list[Run] = []
        for day in reversed(days):
            merged = self._merge(self.manifest.read([day, *found[-1:]], schema))
            found.append(self.manifest.write(merged, "suffix", 0, day.first, days[-1].last))
        return found

    def parts(self) -> list[Run]:
        """The folders that make up the current window: at most one suffix and one prefix."""
        runs = self.manifest.latest()[1]
        prefix = [r for r in runs if r.kind == "prefix"]
        suffixes = sorted((r for r in runs if r.kind == "suffix" and r.first > prefix[0].last - self.span),
                          key=lambda r: r.first)
        return suffixes[:1] + prefix

    def merged(self) -> DataFrame:
        """``by..., sketch`` of the ``window`` periods up to the last one added."""
        _, runs = self.manifest.latest()
        return self._merge(self.manifest.read(self.parts() if runs else []))
