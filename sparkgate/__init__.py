"""sparkgate: a Spark-native customer-signal, identity-verification and access-decision engine.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, windows, joins and ``pyspark.ml``.
"""

__version__ = "0.1.0"
