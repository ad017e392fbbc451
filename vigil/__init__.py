"""vigil: Spark-native sensor anomaly analytics (ingest, features, scoring, reports, serving, streams)."""

__version__ = "0.1.0"
