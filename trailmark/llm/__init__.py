"""Operators for preparing training text at scale.

The functions that run inside tasks travel with the job, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
