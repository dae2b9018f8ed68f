"""Operators for training-data pipelines. Nothing else in the library imports this subpackage.

Every operator takes DataFrames and returns a DataFrame; texts that are NULL count as empty.
"""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so that those need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
