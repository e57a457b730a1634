"""Content and audience keyword analytics, written as Spark DataFrame operators."""

__version__ = "0.1.0"
