"""Removed-upvote analytics over forum dumps, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors get the library's Python helpers with the job. pandas, pyarrow, numpy and, for
# zstd dumps, zstandard must be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
