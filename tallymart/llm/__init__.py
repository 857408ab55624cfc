"""Operators for preparing text corpora: dedup, filtering, scanning, sharding and packing.

Nothing else in the library imports this package. ``queries.py`` holds the registered queries,
``oracle.py`` the matching SQL where there is one.
"""

import sys

from pyspark import cloudpickle

# Functions that run in executors travel with their code: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
