"""Column functions over tuple sketches.

A sketch is one struct value::

    STRUCT<theta BIGINT, k INT, num_values INT, hash STRING,
           entries ARRAY<STRUCT<h BIGINT, values ARRAY<DOUBLE>>>>

``entries`` holds, sorted by ``h``, every key whose 60-bit hash is below
``theta`` (at most ``k`` of them); ``theta = 2^60`` means nothing was sampled
away and the sketch is exact.  The estimated number of distinct keys is
``size(entries) / (theta / 2^60)``.  This is the bottom-k / theta-sketch
scheme (Bar-Yossef et al. 2002; Beyer et al. 2007; Dasgupta et al. 2016).

Everything here is a plain Catalyst expression (higher-order functions, no
UDF), so it runs in the JVM and never shuffles.  Spark evaluates higher-order
functions row by row, outside whole-stage code generation.
"""

from __future__ import annotations

from typing import Optional, Union

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exprs import TupleExpr, as_double, as_double_sql, to_spark_sql, truthy, truthy_sql
from .hashing import DEFAULT_K, THETA_MAX, check_hash_kind

ENTRY_TYPE = T.StructType([
    T.StructField("h", T.LongType()),
    T.StructField("values", T.ArrayType(T.DoubleType())),
])
ENTRIES_TYPE = T.ArrayType(ENTRY_TYPE)
SKETCH_TYPE = T.StructType([
    T.StructField("theta", T.LongType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("num_values", T.IntegerType()),
    T.StructField("hash", T.StringType()),
    T.StructField("entries", ENTRIES_TYPE),
])

SketchLike = Union[Column, str]
_LAMBDA_VAR = "__tc_e"


def _col(s: SketchLike) -> Column:
    return F.expr(s) if isinstance(s, str) else s


def make_sketch(theta: Column, k: Column, num_values: Column, hash_kind: Column,
                entries: Column) -> Column:
    return F.struct(
        theta.cast("bigint").alias("theta"),
        k.cast("int").alias("k"),
        num_values.cast("int").alias("num_values"),
        hash_kind.cast("string").alias("hash"),
        entries.alias("entries"),
    )


def empty_sketch(num_values: int, k: int = DEFAULT_K, hash: str = "md5") -> Column:
    """A sketch with no entries and theta = 2^60 (the estimate is 0)."""
    check_hash_kind(hash)
    return make_sketch(F.lit(THETA_MAX), F.lit(k), F.lit(num_values), F.lit(hash),
                       F.array().cast(ENTRIES_TYPE))


def theta_fraction(sketch: SketchLike) -> Column:
    """Sampling rate of a sketch, 1.0 when exact."""
    return _col(sketch)["theta"].cast("double") / F.lit(float(THETA_MAX))


def sketch_retained(sketch: SketchLike) -> Column:
    """Number of entries held (reads only the ``h`` leaf of a stored sketch)."""
    s = _col(sketch)
    return F.when(s.isNotNull(), F.size(s["entries"]["h"]))


def sketch_estimate(sketch: SketchLike) -> Column:
    """Estimated distinct-key count; null for a null sketch."""
    s = _col(sketch)
    return F.when(s.isNotNull(),
                  F.size(s["entries"]["h"]).cast("double") / theta_fraction(s))


def _rebuilt(s: Column, entries: Column, num_values: Column) -> Column:
    # No survivors -> an empty sketch with the default theta; otherwise the
    # input theta is carried so estimates stay scaled.
    theta = F.when(F.size(entries) == 0, F.lit(THETA_MAX)).otherwise(s["theta"])
    out = make_sketch(theta, s["k"], num_values, s["hash"], entries)
    return F.when(s.isNotNull(), out)


def filter_tuples(sketch: SketchLike, pred: TupleExpr) -> Column:
    """Keep the entries whose tuple satisfies ``pred``; tuples are unchanged.

    ``sketch`` is a Column, or SQL text (e.g. a column name) which string
    predicates require."""
    s = _col(sketch)
    if isinstance(pred, str):
        if not isinstance(sketch, str):
            raise TypeError("a string predicate needs the sketch as SQL text (a column name); "
                            "name the column with withColumn() or pass a Python callable")
        body = truthy_sql(to_spark_sql(pred, f"{_LAMBDA_VAR}.values"))
        kept = F.expr(f"filter(({sketch}).entries, {_LAMBDA_VAR} -> {body})")
    else:
        kept = F.filter(s["entries"], lambda e: truthy(pred(e["values"])))
    return _rebuilt(s, kept, s["num_values"])


def collapse_tuples(sketch: SketchLike, expr: TupleExpr) -> Column:
    """Replace every tuple by a length-1 tuple holding ``expr`` (null -> 0.0)."""
    s = _col(sketch)
    if isinstance(expr, str):
        if not isinstance(sketch, str):
            raise TypeError("a string expression needs the sketch as SQL text (a column name); "
                            "name the column with withColumn() or pass a Python callable")
        body = as_double_sql(to_spark_sql(expr, f"{_LAMBDA_VAR}.values"))
        collapsed = F.expr(
            f"transform(({sketch}).entries, {_LAMBDA_VAR} -> "
            f"named_struct('h', {_LAMBDA_VAR}.h, 'values', array({body})))")
    else:
        collapsed = F.transform(
            s["entries"],
            lambda e: F.struct(e["h"].alias("h"),
                               F.array(as_double(expr(e["values"]))).alias("values")))
    return _rebuilt(s, collapsed, F.lit(1))


def sketch_slot_sum(sketch: SketchLike, i: int) -> Column:
    """Sum of slot ``i`` over the retained entries (unscaled)."""
    s = _col(sketch)
    return F.when(s.isNotNull(), F.aggregate(
        s["entries"], F.lit(0.0), lambda acc, e: acc + F.coalesce(F.get(e["values"], i), F.lit(0.0))))


def combine_sketches(a: SketchLike, b: SketchLike, k: Optional[int] = None) -> Column:
    """Union of two sketches in the same row; tuples of equal keys are summed.

    A null side counts as empty, so two nulls give an empty sketch.  Widths
    and hash kinds must agree (checked when the row is evaluated).  No
    shuffle: this is a per-row expression."""
    a, b = _col(a), _col(b)
    # The checks are part of theta, which every reader needs, so that no plan prunes them.
    both = a.isNotNull() & b.isNotNull()
    theta = F.when(both & (a["num_values"] != b["num_values"]),
                   F.raise_error(F.lit("cannot combine sketches of different num_values")).cast("bigint")) \
        .when(both & (a["hash"] != b["hash"]),
              F.raise_error(F.lit("cannot combine sketches built with different hash kinds")).cast("bigint")) \
        .otherwise(F.least(F.coalesce(a["theta"], F.lit(THETA_MAX)),
                           F.coalesce(b["theta"], F.lit(THETA_MAX))))
    k_out = F.lit(k) if k is not None else F.coalesce(F.least(a["k"], b["k"]), a["k"], b["k"],
                                                      F.lit(DEFAULT_K))
    width = F.coalesce(a["num_values"], b["num_values"], F.lit(1))
    hash_kind = F.coalesce(a["hash"], b["hash"], F.lit("md5"))
    empty = F.array().cast(ENTRIES_TYPE)
    ma = F.map_from_entries(F.coalesce(a["entries"], empty))
    mb = F.map_from_entries(F.coalesce(b["entries"], empty))
    summed = F.map_zip_with(
        ma, mb,
        lambda _h, x, y: F.when(x.isNull(), y).when(y.isNull(), x)
        .otherwise(F.zip_with(x, y, lambda p, q: p + q)))
    ordered = F.array_sort(F.transform(
        F.map_entries(summed),
        lambda e: F.struct(e["key"].alias("h"), e["value"].alias("values"))))
    kept = F.filter(ordered, lambda e: e["h"] < theta)
    n = F.size(kept)
    new_theta = F.when(n > k_out, F.element_at(kept, k_out + 1)["h"]).otherwise(theta)
    entries = F.slice(kept, 1, k_out)
    # The same checks for readers of one of the two small fields alone.
    width = F.when(theta.isNotNull(), width)
    hash_kind = F.when(theta.isNotNull(), hash_kind)
    return make_sketch(new_theta, k_out, width, hash_kind, entries)


def _checked_theta(a: Column, b: Column, what: str, same_width: bool) -> Column:
    """The smaller theta of two sketches; raises where a row's kinds (or widths) differ."""
    both = a.isNotNull() & b.isNotNull()
    theta = F.when(both & (a["hash"] != b["hash"]),
                   F.raise_error(F.lit(f"cannot {what} sketches built with different hash kinds")).cast("bigint"))
    if same_width:
        theta = theta.when(both & (a["num_values"] != b["num_values"]),
                           F.raise_error(F.lit(f"cannot {what} sketches of different num_values")).cast("bigint"))
    return theta.otherwise(F.least(F.coalesce(a["theta"], F.lit(THETA_MAX)), F.coalesce(b["theta"], F.lit(THETA_MAX))))


def _zipped(a: Column, b: Column, theta: Column, merge) -> Column:
    """Entries below theta, one per hash of either side, with ``merge(values of a, values of b)``; null ones go.

    The two sides meet in one hash map per row, so this is linear in their entries."""
    empty = F.array().cast(ENTRIES_TYPE)
    ma, mb = (F.map_from_entries(F.filter(F.coalesce(s["entries"], empty), lambda e: e["h"] < theta)) for s in (a, b))
    met = F.map_entries(F.map_zip_with(ma, mb, lambda _h, x, y: merge(x, y)))
    kept = F.filter(met, lambda e: e["value"].isNotNull())
    return F.array_sort(F.transform(kept, lambda e: F.struct(e["key"].alias("h"), e["value"].alias("values"))))


def intersect_sketches(a: SketchLike, b: SketchLike, values: str = "sum") -> Column:
    """Keys of both sketches: a sample of the intersection under the smaller theta.

    ``values``: ``"sum"`` adds the tuples slot by slot (widths must agree), ``"left"`` keeps those of
    ``a``, ``"concat"`` puts those of ``b`` behind them.  A null side counts as empty, so the result is
    then an empty sketch.  Theta stays the smaller one even if no key is left: a sampled sketch cannot
    tell that the intersection is empty (its upper bound is above 0).  No shuffle."""
    if values not in ("sum", "left", "concat"):
        raise ValueError(f"values must be 'sum', 'left' or 'concat', got {values!r}")
    a, b = _col(a), _col(b)
    theta = _checked_theta(a, b, "intersect", same_width=values == "sum")
    put = {"sum": lambda x, y: F.zip_with(x, y, lambda p, q: p + q), "left": lambda x, y: x,
           "concat": lambda x, y: F.concat(x, y)}[values]
    entries = _zipped(a, b, theta, lambda x, y: F.when(x.isNotNull() & y.isNotNull(), put(x, y)))
    width = F.coalesce(a["num_values"], b["num_values"], F.lit(1))
    if values == "concat":
        width = F.coalesce(a["num_values"], F.lit(0)) + F.coalesce(b["num_values"], F.lit(0))
    return _set_result(a, b, theta, width, entries)


def a_not_b(a: SketchLike, b: SketchLike) -> Column:
    """Keys of ``a`` that are not in ``b``, with the tuples of ``a``, under the smaller theta.

    A null ``b`` takes nothing away; a null ``a`` gives an empty sketch.  ``b`` may have another width."""
    a, b = _col(a), _col(b)
    theta = _checked_theta(a, b, "subtract", same_width=False)
    entries = _zipped(a, b, theta, lambda x, y: F.when(y.isNull(), x))
    return _set_result(a, b, theta, F.coalesce(a["num_values"], b["num_values"], F.lit(1)), entries)


def _set_result(a: Column, b: Column, theta: Column, width: Column, entries: Column) -> Column:
    k = F.coalesce(F.least(a["k"], b["k"]), a["k"], b["k"], F.lit(DEFAULT_K))
    kind = F.coalesce(a["hash"], b["hash"], F.lit("md5"))
    # The checks of theta hold for readers of one of the small fields alone, too.
    return make_sketch(theta, k, F.when(theta.isNotNull(), width), F.when(theta.isNotNull(), kind), entries)


def sketch_bounds(sketch: SketchLike, z: float = 2.0) -> Column:
    """``struct<lower, estimate, upper>``: score interval of the distinct-key count, ``z`` standard deviations wide.

    n retained keys are a binomial draw at rate p = theta / 2^60 from the N keys, so the bounds are the two N with
    (n - N p)^2 = z^2 N p (1 - p); the lower one is at least n.  An exact sketch has all three equal."""
    s = _col(sketch)
    n, p = F.size(s["entries"]["h"]).cast("double"), theta_fraction(s)
    q = F.lit(float(z) ** 2) * (F.lit(1.0) - p)
    spread = F.sqrt(q * (q + 4 * n))
    lower, upper = ((2 * n + q + sign * spread) / (2 * p) for sign in (-1, 1))
    return F.when(s.isNotNull(), F.struct(F.greatest(n, lower).alias("lower"), (n / p).alias("estimate"),
                                          upper.alias("upper")))


def sketch_sum(sketch: SketchLike, i: int) -> Column:
    """Estimated sum of slot ``i`` over all keys: the retained sum over the sampling rate."""
    s = _col(sketch)
    return sketch_slot_sum(s, i) / theta_fraction(s)


def sketch_sum_bounds(sketch: SketchLike, i: int, z: float = 2.0) -> Column:
    """``struct<lower, estimate, upper>`` of the sum of slot ``i``: inverse-probability estimate with its own variance
    estimate, (1 - p) / p^2 times the retained sum of squares.  An exact sketch has all three equal."""
    s = _col(sketch)
    p = theta_fraction(s)
    squares = F.aggregate(s["entries"], F.lit(0.0), lambda acc, e: acc + F.pow(F.coalesce(F.get(e["values"], i), F.lit(0.0)), 2))
    est = sketch_sum(s, i)
    half = F.lit(float(z)) * F.sqrt((F.lit(1.0) - p) * squares) / p
    return F.when(s.isNotNull(), F.struct((est - half).alias("lower"), est.alias("estimate"), (est + half).alias("upper")))


def sketch_mean(sketch: SketchLike, i: int) -> Column:
    """Mean of slot ``i`` over the keys (the retained keys' mean); null for a sketch without keys."""
    s = _col(sketch)
    return sketch_slot_sum(s, i) / F.nullif(F.size(s["entries"]["h"]).cast("double"), F.lit(0.0))


def sketch_valid(sketch: SketchLike) -> Column:
    """True when a sketch keeps the format's invariants (null sketches count as valid):
    0 < theta <= 2^60, at most ``k`` entries, every hash in [0, theta), hashes strictly
    increasing, every tuple of width ``num_values``, a known hash kind."""
    from .hashing import HASH_KINDS
    s = _col(sketch)
    e = s["entries"]
    n = F.size(e)
    sorted_ok = F.when(n > 1, F.forall(
        F.sequence(F.lit(2), n),
        lambda i: F.element_at(e, i - 1)["h"] < F.element_at(e, i)["h"])).otherwise(F.lit(True))
    ok = ((s["theta"] > 0) & (s["theta"] <= F.lit(THETA_MAX)) & (n <= s["k"])
          & F.forall(e, lambda x: (x["h"] >= 0) & (x["h"] < s["theta"])
                     & (F.size(x["values"]) == s["num_values"]))
          & sorted_ok & s["hash"].isin(*HASH_KINDS))
    return s.isNull() | F.coalesce(ok, F.lit(False))
