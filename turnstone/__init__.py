"""Turnstone: ticketing, attendance and customer analytics as Spark DataFrame jobs."""
