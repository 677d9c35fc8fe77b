"""modrisk: Spark-native analytics for finding risky source modules."""

__version__ = "0.1.0"
