"""Incremental star-schema loading expressed as Spark DataFrame work."""

import sys

from pyspark import cloudpickle

# Functions and classes of the package travel with the tasks that use them, so that
# executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
