"""Training-data operators at corpus scale. Nothing else in the library imports this.

Python workers import this package, so they must find it. On a cluster it is
installed or shipped with ``--py-files``; where the driver runs it from a source
folder, the folder is put on the workers' path here.
"""

import os

from pyspark import SparkContext


def _tell_workers() -> None:
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    places = [os.environ]  # a session started later
    if SparkContext._active_spark_context is not None:
        places.append(SparkContext._active_spark_context.environment)
    for env in places:
        known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in known:
            env["PYTHONPATH"] = os.pathsep.join([*known, root])


_tell_workers()
