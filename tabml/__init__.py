"""tabml: tabular profiling, feature preparation, training, scoring and
evaluation on Spark DataFrames.

Every function takes and returns DataFrames (or ``pyspark.ml`` objects) and
leaves the SparkSession to the caller. Data stays on the executors; only
bounded statistics (one value per column, per label or per grid point) ever
reach the driver.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
