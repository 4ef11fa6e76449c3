"""Spark-native landing, validation, cleansing and upsert of provider and claims data."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions run in Python workers travel with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
