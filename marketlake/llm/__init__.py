"""Training-data operators: deduplication, classification, search, packing and scoring of documents."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value: nothing has to be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
