"""Document ingestion and retrieval analytics as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python tasks carry the few helper functions with them, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
