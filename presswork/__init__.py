"""presswork: news-ingestion analytics written as Spark DataFrame jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# The few Python functions travel to executors with the query, so the package
# needs to be installed on the driver only.
register_pickle_by_value(sys.modules[__name__])
