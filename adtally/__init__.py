"""adtally: loading and summarising advertising-spend reports on Spark."""

__version__ = "0.1.0"
