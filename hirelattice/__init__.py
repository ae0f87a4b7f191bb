"""Labour-market analytics as Spark jobs: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# The small helpers that run inside tasks travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
