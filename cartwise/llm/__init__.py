"""Training-data pipeline operators (packing, near and exact duplicates,
license scan, chat formatting, URL filter, mixing, language, quality,
embedding duplicates).  Nothing else in the package imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
