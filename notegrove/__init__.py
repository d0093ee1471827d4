"""Search and analytics over review-like records, written as ordinary Spark plans."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors need not have the package installed: its functions travel with their tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
