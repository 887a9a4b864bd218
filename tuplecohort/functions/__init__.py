from .exprs import slot, to_spark_sql
from .hashing import THETA_MAX, key_hash
from .metrics import Metric
from .sketch import (SKETCH_TYPE, a_not_b, collapse_tuples, combine_sketches, empty_sketch,
                     filter_tuples, intersect_sketches, sketch_bounds, sketch_estimate, sketch_mean,
                     sketch_retained, sketch_slot_sum, sketch_sum, sketch_sum_bounds, sketch_valid,
                     theta_fraction)

__all__ = ["Metric", "slot", "to_spark_sql", "THETA_MAX", "key_hash", "SKETCH_TYPE",
           "a_not_b", "collapse_tuples", "combine_sketches", "empty_sketch", "filter_tuples",
           "intersect_sketches", "sketch_bounds", "sketch_mean", "sketch_sum", "sketch_sum_bounds",
           "sketch_estimate", "sketch_retained", "sketch_slot_sum", "sketch_valid", "theta_fraction"]
