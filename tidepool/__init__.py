"""Market-microstructure and corpus analytics as composable Spark DataFrame transforms."""

import sys

from pyspark import cloudpickle

# Functions handed to executors travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
