"""agorasift: a Spark-native engine for collecting, cleaning, scoring and balancing short political texts."""

__version__ = "0.1.0"
