"""Market-tick analytics as plain DataFrame functions on Apache Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with their code: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
