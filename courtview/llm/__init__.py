"""Training-data operators: dedup, decontamination, mixing, sharding, scans, search and quality scoring.

Each module holds one operator with a general interface; ``queries.py`` holds the thin registered queries.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# functions sent to Python workers travel whole: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
