"""Survey features, contrasts and classification on PySpark."""

import sys

from pyspark import cloudpickle

# Send the small task functions with the job, so that executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
