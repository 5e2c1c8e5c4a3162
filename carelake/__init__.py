"""carelake: clinic appointment analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, joins, aggregates and windows; column names are parameters.

Sub-packages:

* ``carelake.functions``  column expressions (names, ages, calendar features)
* ``carelake.sources``    declared-schema readers, catalog access, sinks, fixtures
* ``carelake.operators``  transforms, joins, history windows, quality checks, ML
* ``carelake.plans``      composite jobs (daily ETL, feature build, training/scoring)
* ``carelake.streaming``  incremental (file-stream) form of the appointment ETL
"""

from carelake import schemas  # noqa: F401

__all__ = ["schemas"]
