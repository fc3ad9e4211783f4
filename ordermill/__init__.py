"""ordermill: order and event data quality, enrichment and monitoring as Spark jobs."""

__version__ = "0.1.0"
