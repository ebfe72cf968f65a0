"""Data quality, feature tables, evaluation and error analysis for manufacturing data on Spark."""
