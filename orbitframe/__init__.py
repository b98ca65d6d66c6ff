"""orbitframe: catalogue analytics expressed as Spark DataFrame plans."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Functions sent to executors travel by value, so that workers need no installed copy.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
