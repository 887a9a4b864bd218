"""DataFrame-level helpers over sketch columns (no shuffle unless stated)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import TupleExpr
from ..functions.sketch import collapse_tuples, filter_tuples, sketch_estimate


def transform_chain(df: DataFrame, sketch: str, steps: Sequence[tuple[str, TupleExpr]],
                    out: str | None = None) -> DataFrame:
    """Apply ``("filter", expr)`` / ``("collapse", expr)`` steps in order.

    Each step reads the previous one by name, so ``$i`` strings work at every
    step; Catalyst collapses the projections into one."""
    out = out or sketch
    cur = sketch
    for i, (op, expr) in enumerate(steps):
        nxt = out if i == len(steps) - 1 else f"__tc_step{i}"
        if op == "filter":
            col = filter_tuples(_sql_name(cur), expr)
        elif op == "collapse":
            col = collapse_tuples(_sql_name(cur), expr)
        else:
            raise ValueError(f"unknown step {op!r}; expected 'filter' or 'collapse'")
        df = df.withColumn(nxt, col)
        cur = nxt
    return df.drop(*[f"__tc_step{i}" for i in range(len(steps) - 1)])


def sketch_entries(df: DataFrame, sketch: str = "sketch", keep: Sequence[str] = ()) -> DataFrame:
    """One row per retained entry: ``keep..., h, values`` (raw tuples)."""
    e = df.select(*keep, F.explode(F.col(sketch)["entries"]).alias("__tc_e"))
    return e.select(*keep, F.col("__tc_e")["h"].alias("h"), F.col("__tc_e")["values"].alias("values"))


def order_by_estimate(df: DataFrame, sketch: str = "sketch", ascending: bool = True,
                      then: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Order rows by the sketch estimate, null sketches first, ties by ``then``.

    With ``limit`` this plans as a top-k (TakeOrderedAndProject): each task
    keeps its best ``limit`` rows, so nothing unbounded reaches one task."""
    est = sketch_estimate(F.col(sketch))
    order = est.asc_nulls_first() if ascending else est.desc_nulls_first()
    out = df.orderBy(order, *[F.col(c).asc() for c in then])
    return out.limit(limit) if limit is not None else out


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
