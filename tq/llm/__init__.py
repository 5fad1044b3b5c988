"""Operators of a training-data pipeline, one module per operator.

The package is pickled by value, so that its row functions reach executors
that do not have this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
