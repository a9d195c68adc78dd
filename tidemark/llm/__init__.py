"""Operators of a training-data pipeline: search, scoring, cleaning, packing.

Nothing else in the library imports this package. Its functions run inside
Spark's Python workers; they are shipped by value, so that the workers need not
have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
