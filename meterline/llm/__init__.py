"""Operators for training data: deduplication, filters, tokens, packing and sharding.

Nothing else in the library imports this subpackage. Its functions travel to the executors by value, so a
cluster needs the public libraries they call but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
