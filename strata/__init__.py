"""strata: adaptive profiling, analytics and a layered warehouse on Spark.

The few Python functions that run inside executors (Arrow-batched
``mapInPandas`` / ``applyInPandas`` mappers for Excel parsing, magic bytes and
file landing) are shipped by value with each task, so executors do not need
this package installed.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
