"""Operators for preparing training data: one module per operator.

Nothing else in the library imports this package; ``queries`` registers what the
driver runs.
"""

import sys

from pyspark import cloudpickle

# The functions that tasks run travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
