"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Code of this package travels with the tasks, so that workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
