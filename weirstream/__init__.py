"""Hydrometric time-series engine on PySpark: ingest, quality control, rating, catalogue and export as DataFrame plans."""

__version__ = "0.2.0"
