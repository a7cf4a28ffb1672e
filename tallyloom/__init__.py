"""Retail star-schema analytics on PySpark."""

import sys

from pyspark import cloudpickle

# The few Python helpers run inside tasks travel with the tasks, so the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
