"""Composed plans: the query catalog, feature pipelines and model jobs."""
