"""Outbreak-onset analytics on Spark: cleaning, quality gates, curation,
onset ranks, Schulze election rankings and predictor search.

Functions that run inside Python workers (the election kernel, the p-value
UDF, the workbook parser) are shipped with the task by value, so executors
need no installed copy of this package.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
