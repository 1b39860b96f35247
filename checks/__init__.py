"""Queries on the given tables, each with the SQL that must give the same rows."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # batch functions travel with their tasks

from checks import audio, batching, files, reports, sampling, scoring, text  # noqa: E402, F401  (they register themselves)
from checks.registry import QUERIES, SQL  # noqa: E402, F401
