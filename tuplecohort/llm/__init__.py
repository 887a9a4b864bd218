"""Training-data operators: WARC archives, exact vector search, language ID,
token files, decontamination, secret scans, repeated-passage removal, PII
surrogates, source mixing and the n-gram Jaccard join.

Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their tasks, so that the library
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
