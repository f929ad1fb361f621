"""Training-data operators: one module for each, and the queries that apply them to whole tables.

Nothing else in the package imports this subpackage. Functions that run inside Python tasks
are shipped to the executors with the job, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
