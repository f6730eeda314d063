"""tagwerk: daily indicator series on Spark.

Long tables of one row per entity and calendar day are prepared, compared
with the previous calendar day, totalled per day, checked against a table
contract and published.  Every step is a DataFrame / SQL / Structured
Streaming operator; see README.md for the operator map.
"""

__version__ = "0.1.0"
