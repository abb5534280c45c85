"""Training-data operators: one module per operator, and ``queries`` with one query for each.

Nothing else in the library imports this package.  Its functions travel to executors by
value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
