"""Operators for preparing training text: cleaning, deduplication, scoring,
mixing, archives and vector search, each a Spark job over whole tables.

Nothing else in the library imports this subpackage.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job instead of being imported
# on the executors, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
