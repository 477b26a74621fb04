"""Tabular preparation, anonymization and model evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job, so workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
