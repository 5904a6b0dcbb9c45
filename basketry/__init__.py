"""basketry: behaviour-log and text-classification analytics as Spark jobs.

Every public function takes and returns DataFrames (or fitted Spark ML
models); none creates a session, collects rows to the driver or uses an RDD
(the legacy mllib SGD job excepted, because that API only accepts RDDs).
"""

__version__ = "0.1.0"
