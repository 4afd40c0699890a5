"""Operators of a training-data pipeline: cleaning, deduplication, packing, search, sharding.

Nothing else in the library imports this subpackage.  Its worker functions are pickled by
value, so executors need the libraries they call but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
