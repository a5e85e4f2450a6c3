"""Disclosure and corpus analytics as Spark DataFrame jobs."""
