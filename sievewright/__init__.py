"""sievewright: a Spark-native engine for curating and mixing conversational training data."""

__version__ = "0.1.0"
