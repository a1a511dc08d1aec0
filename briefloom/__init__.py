"""Briefloom: a Spark-first engine for deal-news directories."""
