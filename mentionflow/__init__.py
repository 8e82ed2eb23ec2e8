"""Keyword monitoring and sentiment reporting as Spark jobs."""
