"""estatelens: fleet-wide database estate analytics on Spark.

Every operator is a pure function from catalog-role DataFrames to a
DataFrame. Nothing here changes a database; remedies are returned as text.
"""

__version__ = "0.1.0"
