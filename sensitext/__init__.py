"""Sensitive-text classification over large tables, written for PySpark.

Sub-packages: ``sources`` (readers, sinks, model storage), ``functions`` (column
expressions), ``operators`` (DataFrame-to-DataFrame work), ``streaming`` (scoring of
text streams) and ``plans`` (the registered queries and their SQL twins).
"""

import sys

from pyspark import cloudpickle

# The few Python UDF bodies of this package travel to executors by value, so a job
# also runs where only the driver has the package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
