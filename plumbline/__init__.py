"""plumbline: data-quality, integration and analysis operators for Spark DataFrames."""

__version__ = "0.1.0"
