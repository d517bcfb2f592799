"""martkit: raw item feeds and web pages to a checked star-schema mart, on Spark."""

__version__ = "0.1.0"
