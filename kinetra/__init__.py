"""kinetra: vehicle-trajectory warehouse built from Spark DataFrame, SQL and
Structured Streaming operations.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``sources``    ragged text files -> track / frame / reject frames
* ``operators``  idempotent load, staging, deltas, kinematics, marts,
                 incremental merge, data-quality checks
* ``functions``  Column helpers (surrogate key, haversine, speed bucket) and
                 distributed exact percentiles
* ``plans``      the transform run, the dashboard questions and the query
                 registry used by ``__spark_entry__``
* ``streaming``  new-file micro-batch ingest and fact refresh
"""

__all__ = ["session"]
