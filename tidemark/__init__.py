"""tidemark: daily market metrics for asset time series, as plain Spark DataFrames.

Layers: raw landing -> bronze (text, append-only stream) -> silver (one row per
asset and day) -> gold (ranking, change, market and asset summaries) -> reports.
Every operator takes DataFrames and returns a DataFrame.
"""

__version__ = "0.1.0"
