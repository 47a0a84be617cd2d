"""Operations of a large-scale training-data pipeline, each a function over DataFrames.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
