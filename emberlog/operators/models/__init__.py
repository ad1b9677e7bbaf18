"""Anomaly models fitted and applied as Spark jobs; every fitted model is a small table."""
