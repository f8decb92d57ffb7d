"""Operators of a training-data pipeline: deduplication, filtering, extraction,
mixing and packing of documents.

Nothing else in the library imports this subpackage. Its functions are shipped
to the Python workers by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
