from pyspark.sql import Column, functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)
