"""Document-structure analytics on Spark: text tables in, queryable structure out."""

__version__ = "0.1.0"
