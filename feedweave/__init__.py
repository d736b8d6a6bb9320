"""Supplier price-list consolidation as Spark DataFrame jobs."""
