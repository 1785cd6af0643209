"""Training-data operators: deduplication, packing, mixing, scoring and rules.

Nothing else in the library imports this subpackage; it imports the session
helpers of the library. ``queries.py`` holds its registered queries.
"""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions of it that run in tasks travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
