"""Operators for large-scale training-data pipelines (each one module, see ``catalog``)."""

import sys

from pyspark import cloudpickle

# Functions of this package that run inside Python tasks travel with the job, so
# executors need no copy of the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
