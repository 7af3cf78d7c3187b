"""Ordered reports and the load job, put together from operators."""
