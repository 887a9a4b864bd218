"""Per-key conditional tuple aggregation and cohort counting on Spark."""

from .functions import (SKETCH_TYPE, THETA_MAX, Metric, a_not_b, collapse_tuples, combine_sketches,
                        empty_sketch, filter_tuples, intersect_sketches, key_hash, sketch_bounds,
                        sketch_estimate, sketch_mean, sketch_retained, sketch_slot_sum, sketch_sum,
                        sketch_sum_bounds, sketch_valid, slot, theta_fraction, to_spark_sql)
from .operators import (collapse_rows, count_keys, cube_sketches, filter_rows, grouping_sketches,
                        intersect_groups, merge_sketches, order_by_estimate, rollup_sketches,
                        sketch_entries, sliding_sketches, top_groups, transform_chain, tuple_rollup, tuple_sketch)
from .plans import cohort_exact, cohort_sketch, time_bucket, weekly_cohort
from .session import checkpoint_dir, configure, ensure_group_limit, local_session
from .sources import (DyadicIndex, as_sketch_column, check_sketch_column, range_cover, read_sketches,
                      stream_table, write_dyadic, write_sketches)

__all__ = [n for n in dir() if not n.startswith("_")]
