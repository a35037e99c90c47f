"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors with the task, so that an executor needs
# no copy of the library on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
