"""sensorlake: a Spark-native warehouse, quality suite, report layer and
quantile forecaster for hourly counts from fixed sensors.

Every operator is a ``DataFrame -> DataFrame`` transformation (or a Spark ML
estimator).  Nothing but one-row scalars and tree leaf values is collected to
the driver.
"""

__version__ = "0.1.0"
