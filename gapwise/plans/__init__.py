"""Composed plans: the query catalog, Spark ML featurizer and experiment runner."""
