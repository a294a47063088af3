"""Operators for training-data pipelines: quality, ids, language models, extraction, duplicates, search.

The code of this package travels to the executors with the functions that use it, so workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
