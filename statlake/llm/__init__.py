"""Operations of a large-scale training-data pipeline; nothing outside imports this package."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions travel with the jobs that call them, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
