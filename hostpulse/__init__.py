"""Access-log anomaly analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel inside the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
