"""Operators for preparing training text, their queries and the SQL beside them.

Their functions and modules travel to the executors by value, so those need not have the
package; what tasks use must therefore not refer to the rest of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
