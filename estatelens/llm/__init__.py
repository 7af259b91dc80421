"""Training-data pipeline operators on Spark DataFrames.

One module per operator; ``queries`` registers the thin ``opN_*`` queries.
Nothing else in the library imports this subpackage.
"""
