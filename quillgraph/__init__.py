"""quillgraph: a Spark-native engine that turns technical documents into a graph of numbered formulas."""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to the executors by value: no executor needs the package on its path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
