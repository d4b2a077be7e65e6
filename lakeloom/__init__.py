"""lakeloom: a Spark-native medallion (RAW -> Bronze -> Silver -> Gold) pipeline library."""

__version__ = "0.1.0"
