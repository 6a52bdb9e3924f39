"""loam: feature preparation, text/vector analytics and model evaluation on Spark DataFrames.

Library code never creates a SparkSession; every entry point takes the caller's
DataFrames (or session) and returns lazily-planned DataFrames.
"""

__version__ = "0.1.0"
