"""tidemart: a Spark-native retail change-feed warehouse and user-label engine.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; stateful operators have a batch body (window functions) and a
Structured Streaming body (``transformWithStateInPandas``) behind one name.
"""

__version__ = "0.1.0"
