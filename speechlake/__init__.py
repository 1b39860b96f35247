"""speechlake: speech-corpus preparation and scoring as plain Spark jobs."""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors inside the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
