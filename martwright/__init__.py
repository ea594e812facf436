"""martwright: a sales warehouse (typed ingest, star schema with type-2
customer history, version joins, business questions and quality gates)
built as Spark DataFrame jobs."""

__version__ = "0.1.0"
