"""skydrift: delay analytics, model monitoring and drift detection on Spark.

Everything is expressed with DataFrames, Spark SQL, Spark ML and Structured
Streaming. Sub-packages:

* ``sources``   -- table readers, CSV ingest, flight-shaped fixture views
* ``functions`` -- column-expression helpers (keys, hashes, JSON, cyclic time)
* ``operators`` -- staging, sampling, positions/splits, features, metrics,
                   drift statistics, scoring, models, lifecycle, monitoring
* ``plans``     -- the registered query catalogue and its SQL oracles
* ``streaming`` -- Structured Streaming scorer, windows, dedup, drift alarms
"""

from skydrift.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
