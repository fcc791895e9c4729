"""Operators: profiling, quantiles, splits, metrics, models, clustering, graphs."""
