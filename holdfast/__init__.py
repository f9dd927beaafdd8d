"""Contributor-retention analytics expressed as Spark DataFrame jobs."""
