"""The two pipelines of the reference, the full refresh, and the query
catalogue over the driver's test tables."""
