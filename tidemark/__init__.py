"""tidemark: layered warehouse loads, dimensions, facts, checks and analytics as Spark plans."""

__version__ = "0.1.0"
