"""Panel analytics on Spark.

Functions that run inside Python tasks are pickled by value, so executors need pyspark
and its Python libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
