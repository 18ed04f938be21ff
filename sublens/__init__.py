"""sublens — daily subscription-lifecycle metrics on Spark DataFrames."""

__version__ = "0.1.0"
