"""parchment: document-recognition analytics expressed as Spark DataFrame operators."""

__all__ = ["operators", "functions", "sources", "plans", "streaming"]
