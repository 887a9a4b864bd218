from .build import tuple_sketch
from .lattice import cube_sketches, grouping_sketches, rollup_sketches
from .merge import merge_sketches
from .rollup import collapse_rows, count_keys, filter_rows, tuple_rollup
from .sets import intersect_groups
from .sliding import sliding_sketches
from .top import top_groups
from .transforms import order_by_estimate, sketch_entries, transform_chain

__all__ = ["tuple_sketch", "merge_sketches", "tuple_rollup", "filter_rows", "collapse_rows",
           "count_keys", "cube_sketches", "grouping_sketches", "intersect_groups", "rollup_sketches",
           "sliding_sketches", "top_groups", "order_by_estimate", "sketch_entries", "transform_chain"]
