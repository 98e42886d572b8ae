"""Training-data operators: deduplication, search, archives, extraction, filters, tokens, sharding.

Each module holds one operator with its own general interface; ``queries.py``
holds the registered ``opN_*`` queries.  Functions of this subpackage are
pickled by value, so executors need not be able to import it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
