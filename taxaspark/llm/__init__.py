"""Operators of a training-data pipeline: formatting, search, de-duplication, packing, screening.

The functions that run on executors travel with the tasks (pickled by value),
so executors need this package's dependencies but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
