"""Training-data operators: dedup, scoring, mixing, tokenising, extraction, scans.

Each module holds one operator with a general interface (a DataFrame and
column names in, a DataFrame out); ``queries`` holds the thin registered
queries and their SQL. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
