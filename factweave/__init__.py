"""factweave - Spark-native extraction, grouping, linking and typing of (arg1, rel, arg2) facts."""

__version__ = "0.1.0"
