"""Spark toolkit for sales-style pipelines on tables and streams."""
