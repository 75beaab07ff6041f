"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own general interface; ``queries``
derives the registered ``opN_*`` queries from them.  Nothing else in the
library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent whole: executors need numpy,
# pandas and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
