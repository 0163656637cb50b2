"""weft: a Spark-native record-linkage and data-preparation engine."""

__version__ = "0.1.0"
