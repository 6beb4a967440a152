"""attestra: governed analytics over semi-structured records, on PySpark DataFrames."""

__version__ = "0.1.0"
