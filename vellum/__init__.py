"""vellum: a Spark-native document inventory engine.

Column helpers live in ``vellum.functions`` (Column -> Column), table
readers and writers in ``vellum.sources``, DataFrame -> DataFrame operators
in ``vellum.operators``, whole jobs in ``vellum.plans`` and streaming
ingest in ``vellum.streaming``.
"""

__version__ = "0.1.0"
