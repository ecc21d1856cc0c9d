"""tidemark: monthly economic series on Spark.

Landed JSON/CSV -> bronze tables -> typed silver series with month-on-month
and year-on-year changes -> one monthly fact -> data tests -> export ->
scorecard, latest-value, history and threshold-signal queries.

Every step is a function from DataFrames to a DataFrame built on Spark's own
operators; nothing is computed on the driver.
"""

__version__ = "0.1.0"
