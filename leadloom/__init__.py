"""Lead qualification operators on Spark."""

__version__ = "0.1.0"
