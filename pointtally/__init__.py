"""pointtally: counting and point-set summarization as Spark DataFrame operators."""

__version__ = "0.1.0"
