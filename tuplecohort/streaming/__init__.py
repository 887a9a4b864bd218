from .incremental import (compact_sketches, read_stream_sketches, stream_cohort_exact,
                          stream_sketches, write_batch_sketches)
from .tiers import SlidingSketches, TieredSketches, stream_tiered

__all__ = ["SlidingSketches", "TieredSketches", "compact_sketches", "read_stream_sketches", "stream_cohort_exact",
           "stream_sketches", "stream_tiered", "write_batch_sketches"]
