"""Source-code risk mining as Spark jobs."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its few Python steps travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
