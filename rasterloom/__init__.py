"""Rasterloom: labelled-image datasets prepared, versioned and scored as Spark jobs."""

import sys

from pyspark import cloudpickle

# Arrow kernels and data sources run in Python workers that may not have this
# package installed; pickling it by value ships the code with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
