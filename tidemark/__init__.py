"""tidemark: change data, version history and data auditing as Spark plans.

Python functions that run on executors are pickled by value, so that worker processes need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
