"""Retail demand analytics over daily store-item panels, as Spark jobs."""
