"""Plain form of a result, the same in any table tool.

Dates and times become ISO text, integers long. Whole numbers that may be
missing become double: tools without a missing integer read them as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MAY_BE_MISSING = {
    "like_count",
    "likes",
    "peak_global_rank",
    "runtime_minutes",
    "titles_year_ago",
    "weeks_in_global_top10",
}


def as_report(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        column = F.col(field.name)
        if field.name in MAY_BE_MISSING:
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, TIME_FORMAT).alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return column.cast("long").alias(field.name)
        return column

    return df.select(*[plain(field) for field in df.schema.fields])
