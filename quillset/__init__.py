"""Text-dataset preparation, batch scoring and evaluation as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
