"""Operators of a training-data pipeline: cleaning, linking, weighing and packing large text collections."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so nothing need be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
