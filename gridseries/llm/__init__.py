"""Operators that prepare text corpora for model training, as Spark jobs.

Nothing else in :mod:`gridseries` imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with the job, so that executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
