"""Millrace: a Spark-native multi-source ELT and data-quality library."""

import sys

from pyspark import cloudpickle

__version__ = "1.0.0"

# The few functions that run in Python workers travel with the plan, so executors need pyspark,
# pandas and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
