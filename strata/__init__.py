"""strata — layered (bronze / silver / gold) trip analytics on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
Spark's DataFrame API, so Catalyst prunes columns, pushes filters to the
Parquet scan and plans shuffles; nothing runs on the driver.
"""

__all__ = ["session"]
