"""Asset sampling and batch captioning on Spark."""

__version__ = "0.1.0"
