"""strata: Spark-native bronze / silver / gold operators for Q&A data."""

__version__ = "0.1.0"
