"""Operators of a training-data pipeline over documents, labels and embeddings.

Functions that run in Python workers travel with the job, so executors need no copy
of the package. Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
