"""seedloom: validate, reconcile, reshape and package evidence records on Spark DataFrames."""

__version__ = "0.1.0"
