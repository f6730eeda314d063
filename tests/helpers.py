import datetime as dt

from pyspark.sql import types as T


def d(s: str) -> dt.date:
    """'02/03' -> 2020-03-02 (day/month of 2020)."""
    day, month = s.split("/")
    return dt.date(2020, int(month), int(day))


GROWTH_IN = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("cases", T.IntegerType()),
    T.StructField("deaths", T.IntegerType()), T.StructField("country", T.StringType()),
    T.StructField("continent", T.StringType()),
])


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
