"""Training-data operators: quality, extraction, deduplication, mixing.

Nothing else in the package imports this subpackage.  Its modules are shipped
to the Python workers by value, so executors need no copy of the package on
their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
