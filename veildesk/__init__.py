"""Support-ticket analytics and personal-data redaction as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors get the package's functions inside the tasks, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
