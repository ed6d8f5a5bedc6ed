"""Composed plans: medallion pipeline, dashboard views, query registry."""
