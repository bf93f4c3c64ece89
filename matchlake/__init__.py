"""Change-data joins, as-of facts, reports and alert rules on Spark."""

__version__ = "0.1.0"
