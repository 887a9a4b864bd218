from .dyadic import DyadicIndex, range_cover, write_dyadic
from .store import as_sketch_column, check_sketch_column, read_sketches, stream_table, write_sketches

__all__ = ["DyadicIndex", "as_sketch_column", "check_sketch_column", "range_cover", "read_sketches",
           "stream_table", "write_dyadic", "write_sketches"]
