"""Retail recommendation data jobs on Spark: feature mart, splits, recommenders, metrics."""
