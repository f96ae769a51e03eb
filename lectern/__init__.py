"""lectern: Spark-native catalogue analytics (ingest → Silver → Gold → data tests).

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame →
DataFrame operators), ``sources`` (JSON-lines and star-table inputs),
``streaming`` (exactly-once incremental ingest), ``plans`` (the full run and
the registered queries).
"""

__version__ = "0.1.0"
