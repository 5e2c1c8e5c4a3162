"""The view -> filtered-table sample as a Spark declarative pipeline.

Use from a pipeline spec (``spark-pipelines run``): the runner imports this
file and calls ``define(spark)``; the view is inlined into the table's plan,
so the predicate reaches the scan.  Outside a pipeline run Spark refuses to
register graph elements (``GRAPH_ELEMENT_DEFINED_OUTSIDE_OF_DECLARATIVE_PIPELINE``);
``plans.etl.view_filter_table`` is the same flow as plain batch code.

Settings read from the session: ``carelake.trips.path`` (parquet with a
``fare_amount`` column) and ``carelake.trips.max_fare`` (default 30).
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def define(spark: SparkSession) -> None:
    from pyspark import pipelines as dp

    from carelake.operators.transforms import filter_expr

    path = spark.conf.get("carelake.trips.path")
    max_fare = float(spark.conf.get("carelake.trips.max_fare", "30"))

    @dp.temporary_view(name="taxi_raw")
    def taxi_raw():
        return spark.read.parquet(path)

    @dp.materialized_view(name="filtered_taxis")
    def filtered_taxis():
        return filter_expr(spark.read.table("taxi_raw"), f"fare_amount < {max_fare}")
